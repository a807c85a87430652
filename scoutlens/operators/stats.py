"""Descriptive statistics (G-A6 … G-A24).

Every statistic is one aggregate pass (partial aggregation on the map side);
wide results are unpivoted with ``inline``/``stack`` into long rows. Exact
percentiles go through :mod:`.order_stats` (distributed, no per-group buffer).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .joins import join_small
from .order_stats import exact_quantiles, quantile_columns


def _long(a: DataFrame, rows: list[tuple[str, list]]) -> DataFrame:
    """Unpivot one aggregate row into one row per entry: (column, *values)."""
    arr = F.array(*[F.struct(F.lit(name).alias("column"), *vals) for name, vals in rows])
    return a.select(F.inline(arr))


def run_summary(df: DataFrame, roles: C.Roles = C.DEFAULT_ROLES) -> DataFrame:
    """G-A6: rows, players, leagues, years of a run (one row)."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct(roles.player).alias("n_players"),
        F.count_distinct(roles.league).alias("n_leagues"),
        F.array_join(F.array_sort(F.collect_set(F.col(roles.year).cast("string"))), ",")
        .alias("years"),
    )


def kpis(df: DataFrame, roles: C.Roles = C.DEFAULT_ROLES) -> DataFrame:
    """G-A9: home-page KPIs (one row)."""
    return df.agg(
        F.count_distinct(roles.player).alias("n_players"),
        F.count("*").alias("n_rows"),
        F.count_distinct(roles.league).alias("n_leagues"),
        F.count_distinct(F.when(F.col(roles.target), F.col(roles.player))).alias("n_promoted"),
        F.array_join(F.array_sort(F.collect_set(F.col(roles.year).cast("string"))), ",")
        .alias("years"),
    )


def counts_by(df: DataFrame, col: str, order: list[str]) -> DataFrame:
    """G-A10: rows per category in a fixed category order; absent -> NULL count."""
    spark = df.sparkSession
    cats = spark.createDataFrame([(c, i) for i, c in enumerate(order)], f"{col} string, ord int")
    counts = df.groupBy(col).agg(F.count("*").alias("n_rows"))
    return cats.join(counts, col, "left").orderBy("ord").select(col, "ord", "n_rows")


def distinct_per(df: DataFrame, key: str, col: str, approx: bool = False,
                 out: str = "n_distinct") -> DataFrame:
    """G-A11: distinct values of ``col`` per ``key`` (HLL++ with ``approx``)."""
    agg = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.groupBy(key).agg(agg.alias(out))


def describe_exact(df: DataFrame, cols: list[str]) -> DataFrame:
    """G-A12: count, mean, sample std, min, 25/50/75 %, max per column (exact)."""
    a = df.agg(*[e for c in cols for e in (
        F.count(c).alias(f"n_{c}"), F.avg(c).alias(f"mean_{c}"),
        F.stddev_samp(c).alias(f"std_{c}"), F.min(c).cast("double").alias(f"min_{c}"),
        F.max(c).cast("double").alias(f"max_{c}"))])
    base = _long(a, [(c, [F.col(f"n_{c}").alias("count"), F.col(f"mean_{c}").alias("mean"),
                          F.col(f"std_{c}").alias("std"), F.col(f"min_{c}").alias("min"),
                          F.col(f"max_{c}").alias("max")]) for c in cols])
    q = (quantile_columns(df, [], cols, [0.25, 0.5, 0.75])
         .groupBy("column").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q")))
    q = q.select("column", F.col("`0.25`").alias("p25"), F.col("`0.5`").alias("p50"),
                 F.col("`0.75`").alias("p75"))
    # one row per described column on each side: bounded by the column count
    return base.join(F.broadcast(q), "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def median_by(df: DataFrame, key: str | list[str], cols: list[str]) -> DataFrame:
    """G-A13: exact median of each column per key, long form (key, column, median)."""
    keys = [key] if isinstance(key, str) else list(key)
    return quantile_columns(df, keys, cols, [0.5]).select(
        *keys, "column", F.col("q").alias("median"))


def class_balance(df: DataFrame, entity: str, y: str) -> DataFrame:
    """G-A14: class balance on rows and on entities (entity label = max label).

    One chain: per-entity partial counts, then one aggregate over entities (rows
    with a NULL entity count as rows but not as an entity).
    """
    ent = df.groupBy(entity).agg(F.count("*").alias("_n"), F.count_if(F.col(y)).alias("_p"),
                                 F.bool_or(F.col(y)).alias("_y"))
    a = ent.agg(
        F.sum("_n").alias("n_rows"), F.sum("_p").alias("n_pos_rows"),
        F.count_if(F.col(entity).isNotNull()).alias("n_entities"),
        F.count_if(F.col(entity).isNotNull() & F.col("_y")).alias("n_pos_entities"))
    return a.select(
        "n_rows", "n_pos_rows",
        (F.col("n_pos_rows") * 100.0 / F.col("n_rows")).alias("pos_rate_rows"),
        "n_entities", "n_pos_entities",
        F.floor((F.col("n_entities") - F.col("n_pos_entities"))
                / F.greatest(F.col("n_pos_entities"), F.lit(1))).cast("long").alias("neg_per_pos"))


def promoted_by(df: DataFrame, key: str, entity: str, y: str,
                out: str = "n_promoted") -> DataFrame:
    """G-A15: distinct positive entities per key."""
    return df.where(F.col(y)).groupBy(key).agg(F.count_distinct(entity).alias(out))


def class_mean_diff(df: DataFrame, y: str, cols: list[str]) -> DataFrame:
    """G-A16: mean per class and % difference vs the negative class (0 base -> NULL)."""
    yy = F.col(y).cast("boolean")
    a = df.agg(*[e for c in cols for e in (
        F.avg(F.when(~yy, F.col(c))).alias(f"neg_{c}"),
        F.avg(F.when(yy, F.col(c))).alias(f"pos_{c}"))])
    out = _long(a, [(c, [F.col(f"neg_{c}").alias("mean_neg"), F.col(f"pos_{c}").alias("mean_pos")])
                    for c in cols])
    return out.withColumn("pct_diff", F.when(
        F.col("mean_neg") != 0, (F.col("mean_pos") - F.col("mean_neg")) / F.col("mean_neg") * 100))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """G-A17: pairwise-complete Pearson correlation of every pair, long (a, b, r)."""
    pairs = [(a, b) for a in cols for b in cols]
    agg = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}")
                   for i, (a, b) in enumerate(pairs)])
    arr = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
                    for i, (a, b) in enumerate(pairs)])
    return agg.select(F.inline(arr))


def target_corr(df: DataFrame, y: str, cols: list[str]) -> DataFrame:
    """G-A18: corr(target, column) ranked by |r| descending (target cast to a number)."""
    yv = F.col(y).cast("int").cast("double")
    a = df.agg(*[F.corr(yv, F.col(c).cast("double")).alias(c) for c in cols])
    out = _long(a, [(c, [F.col(c).alias("r")]) for c in cols])
    return out.withColumn("abs_r", F.abs("r")).orderBy(F.col("abs_r").desc_nulls_last(), "column")


def high_corr_pairs(df: DataFrame, cols: list[str], threshold: float = 0.9) -> DataFrame:
    """G-A19: upper-triangle pairs (column order) with |r| > threshold, strongest first."""
    order = {c: i for i, c in enumerate(cols)}
    cm = corr_matrix(df, cols)
    idx = F.create_map(*[e for c, i in order.items() for e in (F.lit(c), F.lit(i))])
    return (cm.where((idx[F.col("a")] < idx[F.col("b")]) & (F.abs("r") > threshold))
            .orderBy(F.abs("r").desc(), "a", "b"))


def pool_by_class(df: DataFrame, player: str, champion: str, y: str) -> DataFrame:
    """G-A20: champion pool per player with the player's class."""
    return df.groupBy(player).agg(F.count_distinct(champion).alias("pool_size"),
                                  F.coalesce(F.bool_or(F.col(y)), F.lit(False)).alias(y))


def z_gap(df: DataFrame, y: str, zcols: list[str]) -> DataFrame:
    """G-A21: mean z of positives minus mean z of negatives, sorted descending."""
    yy = F.col(y).cast("boolean")
    a = df.agg(*[(F.avg(F.when(yy, F.col(c))) - F.avg(F.when(~yy, F.col(c)))).alias(c)
                 for c in zcols])
    return _long(a, [(c, [F.col(c).alias("gap")]) for c in zcols]).orderBy(
        F.col("gap").desc_nulls_last(), "column")


def score_separation(df: DataFrame, y: str, score: str) -> DataFrame:
    """G-A22: median score per class, their difference and class counts (one row)."""
    yy = F.col(y).cast("boolean")
    base = df.select(F.coalesce(yy, F.lit(False)).alias("_y"), F.col(score))
    med = exact_quantiles(base, ["_y"], score, [0.5], "med")
    cnt = base.groupBy("_y").agg(F.count("*").alias("n"))
    # two classes at most on each side
    j = cnt.join(F.broadcast(med), "_y", "left")
    return j.agg(
        F.max(F.when(F.col("_y"), F.col("med"))).alias("median_pos"),
        F.max(F.when(~F.col("_y"), F.col("med"))).alias("median_neg"),
        F.coalesce(F.max(F.when(F.col("_y"), F.col("n"))), F.lit(0)).alias("n_pos"),
        F.coalesce(F.max(F.when(~F.col("_y"), F.col("n"))), F.lit(0)).alias("n_neg"),
    ).withColumn("median_diff", F.col("median_pos") - F.col("median_neg"))


def archetype_expr(prefix: str = "", rules=C.ARCHETYPE_RULES, cols_present=None):
    """M-U7 as one column expression: all matching labels joined, else neutral.

    Absent features count as 0 (the reference's ``r.get(f, 0)``); a NULL value
    also counts as 0 so comparisons never yield NULL.
    """
    def v(f):
        if cols_present is not None and f not in cols_present:
            return F.lit(0.0)
        return F.coalesce(F.col(f"{prefix}{f}"), F.lit(0.0))

    parts = []
    for label, conds in rules:
        cond = None
        for f, t in conds:
            e = v(f) > F.lit(t)
            cond = e if cond is None else (cond & e)
        parts.append(F.when(cond, F.lit(label)))
    bal = None
    for f in C.BALANCED_FEATURES:
        e = F.abs(v(f)) < F.lit(C.BALANCED_LIMIT)
        bal = e if bal is None else (bal & e)
    parts.append(F.when(bal, F.lit(C.BALANCED_LABEL)))
    joined = F.concat_ws(C.LABEL_SEPARATOR, *parts)
    return F.when(joined == "", F.lit(C.NEUTRAL_ARCHETYPE)).otherwise(joined)


def cluster_profiles(df: DataFrame, part: str, cluster: str, y: str | None,
                     feats: list[str] = C.CLUSTER_FEATURES) -> DataFrame:
    """G-A23: size, positives, positive rate, mean features (4 dp) and archetype."""
    aggs = [F.count("*").alias("n_players")]
    if y:
        aggs += [F.count_if(F.col(y)).alias("n_promoted"),
                 F.avg(F.col(y).cast("int").cast("double")).alias("promo_rate")]
    else:
        aggs += [F.lit(0).cast("long").alias("n_promoted"), F.lit(0.0).alias("promo_rate")]
    aggs += [F.avg(f).alias(f"_mean_{f}") for f in feats]
    g = df.groupBy(part, cluster).agg(*aggs)
    out = g.withColumn("archetype", archetype_expr("_mean_", cols_present=None))
    return out.select(part, cluster, "n_players", "n_promoted", "promo_rate", "archetype",
                      *[F.round(f"_mean_{f}", 4).alias(f) for f in feats])


def position_summary(profiles: DataFrame, sweep: DataFrame, part: str = "position",
                     cluster: str = "cluster") -> DataFrame:
    """G-A24: rows, best k, silhouette and the archetype with the highest positive rate
    (lowest cluster id on ties) per position. ``sweep``: (part, best_k, silhouette)."""
    p = profiles.groupBy(part).agg(
        F.sum("n_players").alias("n_rows"),
        F.max_by("archetype", F.struct(F.col("promo_rate"), -F.col(cluster))).alias("best_archetype"),
        F.max("promo_rate").alias("best_rate"))
    return join_small(p, sweep, part, "left")
