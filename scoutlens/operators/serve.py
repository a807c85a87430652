"""Serving queries over the score / cluster tables (P-C9 … P-C14, D-4 … D-8, M-U9).

These are the dashboard's questions as lazy DataFrames: filters (pushed down to
parquet when the stage tables are read from disk), equi-joins with
size-checked broadcasts, and top-k via ``orderBy().limit()``. No join here can
fan out beyond one lookup row per key: best-match lookups pre-reduce the
candidate table to one row per key prefix before joining.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import label, not_in
from .joins import join_small
from .rank import best_per


def leaderboard(df: DataFrame, score: str = "talent_score", positions=None, leagues=None,
                year=None, min_score: float | None = None, position_col: str = "position",
                league_col: str = "league", year_col: str = "_source_year") -> DataFrame:
    """P-C9: optional filters (empty list = no filter), sorted by score descending."""
    out = df
    if positions:
        out = out.where(F.col(position_col).isin(list(positions)))
    if leagues:
        out = out.where(F.col(league_col).isin(list(leagues)))
    if year is not None:
        out = out.where(F.col(year_col) == F.lit(int(year)))
    if min_score is not None:
        out = out.where(F.col(score) >= F.lit(float(min_score)))
    return out.orderBy(F.col(score).desc_nulls_last())


def attach_clusters(scores: DataFrame, clusters: DataFrame, keys: list[str],
                    how: str = "left", cols=("cluster", "archetype")) -> DataFrame:
    """D-4 / D-5: scores joined with cluster labels on ``keys`` (left or inner).

    Only keys present on both sides are used (the reference intersects them);
    without cluster data the label columns are NULL.
    """
    keys = [k for k in keys if k in scores.columns and k in clusters.columns]
    right = clusters.select(*keys, *[c for c in cols if c in clusters.columns])
    return scores.join(right, keys, how)


def attach_archetype(df: DataFrame, profiles: DataFrame, position: str = "position",
                     cluster: str = "cluster", out: str = "archetype_lookup",
                     default: str = C.UNKNOWN_ARCHETYPE) -> DataFrame:
    """D-6: archetype by (lower(position), cluster), default 'Inconnu'.

    ``profiles`` holds one row per (position, cluster) — bounded by positions x k
    — and is broadcast after its size check.
    """
    p = profiles.select(F.lower(F.col(position)).alias("_lp"), F.col(cluster).alias("_lc"),
                        F.col("archetype").alias("_la"))
    j = join_small(df, p, lambda p: (F.lower(df[position]) == p["_lp"]) & (df[cluster] == p["_lc"]), "left")
    return j.withColumn(out, F.coalesce(F.col("_la"), F.lit(default))).drop("_lp", "_lc", "_la")


def shortlist(scores: DataFrame, clusters: DataFrame, profiles: DataFrame, keys: list[str],
              positions=None, leagues=None, min_score: float | None = None, archetype: str | None = None,
              score: str = "talent_score") -> DataFrame:
    """P-C10: scores ⟕ clusters, archetype = stored else rebuilt by lookup, filtered."""
    j = attach_clusters(scores, clusters, keys)
    j = attach_archetype(j, profiles)
    j = j.withColumn("archetype", F.when(F.col("cluster").isNull(), F.lit(None).cast("string"))
                     .otherwise(F.coalesce(F.col("archetype"), F.col("archetype_lookup"))))
    out = leaderboard(j.drop("archetype_lookup"), score, positions, leagues, None, min_score)
    if archetype:
        out = out.where(F.col("archetype") == F.lit(archetype))
    return out


def style_search(df: DataFrame, position: str, archetype_text: str, exclude_leagues,
                 key: str = "playername", score: str = "talent_score", n: int = 5,
                 tiebreak: list[str] | None = None) -> DataFrame:
    """P-C11: position = x, archetype contains the text (literal), league not in the
    list, best row per player, top n."""
    f = df.where((F.col("position") == F.lit(position))
                 & F.contains(F.col("archetype"), F.lit(archetype_text))
                 & not_in("league", exclude_leagues))
    best = best_per(f, [key], score, tiebreak or [])
    return best.orderBy(F.col(score).desc_nulls_last(), *[F.col(c) for c in [key] + (tiebreak or [])]) \
        .limit(n)


def present(df: DataFrame, player: str = "playername", original: str = "playername_original",
            target: str = "promoted_to_lec") -> DataFrame:
    """P-C12: display projection — scores to 1 dp, rates to 3 dp, target as a mark,
    "name (LEAGUE)" label, upper-case position, display name = original else key."""
    out = df
    if original in df.columns:
        out = out.withColumn("display_name", F.coalesce(F.col(original), F.col(player).cast("string")))
    else:
        out = out.withColumn("display_name", F.col(player).cast("string"))
    out = out.withColumn("label", label(F.col("display_name"), F.col("league")))
    for c, nd in (("talent_score", 1), ("score_percentile", 1), ("win_rate", 3)):
        if c in df.columns:
            out = out.withColumn(c, F.round(F.col(c), nd))
    if target in df.columns:
        out = out.withColumn(target, F.when(F.col(target), F.lit("✅")).otherwise(F.lit("❌")))
    if "position" in df.columns:
        out = out.withColumn("position", F.upper("position"))
    return out


def display_names(df: DataFrame, key: str = "playername", original: str = "playername_original",
                  order: list[str] | None = None) -> DataFrame:
    """P-C13: first non-NULL original name per key (deterministic "first": by ``order``)."""
    ordcol = F.when(F.col(original).isNotNull(),
                    F.struct(*[F.col(c) for c in (order or [original])]))
    return df.groupBy(key).agg(F.min_by(original, ordcol).alias("display_name"))


def option_lists(df: DataFrame, cols: list[str]) -> DataFrame:
    """P-C14: sorted distinct non-NULL values per column, as (column, value) rows."""
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                    for c in cols])
    return df.select(F.inline(arr)).where(F.col("value").isNotNull()).distinct() \
        .orderBy("column", "value")


def best_match(ref: DataFrame, rows: DataFrame, player: str, keys: list[str],
               order: list[str], cols: list[str]) -> DataFrame:
    """D-8: for each reference row, the first candidate row of the same player after
    narrowing by ``keys`` in order, stopping before the first key that leaves
    nothing.

    Equivalent to: among the player's rows, those matching the longest prefix
    of ``keys``; the first by ``order``. Computed without pairing rows: for each
    prefix length the candidate table is first reduced to its first row per
    (player, prefix) (``min_by``), then joined once per prefix on equality, and
    the deepest match wins.
    """
    out = ref
    picked = []
    for d in range(len(keys), -1, -1):
        kk = [player] + keys[:d]
        first = rows.groupBy(*kk).agg(F.min_by(F.struct(*[F.col(c) for c in cols]),
                                               F.struct(*[F.col(c) for c in order])).alias(f"_m{d}"))
        first = first.select(*[F.col(k).alias(f"_k{d}_{k}") for k in kk], f"_m{d}")
        cond = [out[k] == first[f"_k{d}_{k}"] for k in kk]
        out = out.join(first, cond, "left").drop(*[f"_k{d}_{k}" for k in kk])
        picked.append(F.col(f"_m{d}"))
    best = F.coalesce(*picked)
    out = out.withColumn("_best", best)
    return out.select(*ref.columns, *[F.col(f"_best.{c}").alias(f"match_{c}") for c in cols])


def same_cluster(df: DataFrame, player_col: str, player, score: str, tiebreak: list[str],
                 part: str = "position", cluster: str = "cluster") -> DataFrame:
    """M-U9: rows in the same (position, cluster) as the player's peak row, the
    player excluded, by score descending — plus the reference row itself."""
    ref = best_per(df.where(F.col(player_col) == F.lit(player)), [player_col], score, tiebreak)
    key = ref.select(F.col(part).alias("_rp"), F.col(cluster).alias("_rc"))
    others = df.where(F.col(player_col) != F.lit(player))
    sim = join_small(others, key, lambda k: (others[part] == k["_rp"]) & (others[cluster] == k["_rc"]),
                     "inner").drop("_rp", "_rc").withColumn("is_reference", F.lit(False))
    return ref.withColumn("is_reference", F.lit(True)).unionByName(sim) \
        .orderBy(F.col("is_reference").desc(), F.col(score).desc_nulls_last(),
                 *[F.col(c) for c in tiebreak])
