"""Ranking metrics without a global window (H-3, M-S3, M-S7 … S10, S12, S14, S17).

Curves and AUCs are closed-form in the distributed prefix sums of
:func:`scoutlens.operators.order_stats.prefix_sums` over distinct thresholds
(scores descending): ``pos_lt``/``n_lt`` count the positives / rows with a
strictly higher score. Nothing is sorted in a single task; the sums are
combined with ordinary aggregates.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.order_stats import prefix_sums


def _y(y: str):
    return F.col(y).cast("int").cast("double")


def threshold_table(df: DataFrame, y: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Per distinct score (descending): tp, fp at ``score >= t`` and class totals."""
    by = list(by or [])
    ps = prefix_sums(df, by, score, {"pos": _y(y)}, descending=True)
    tp = F.col("pos_lt") + F.col("pos_eq")
    pred = F.col("n_lt") + F.col("n_eq")
    return ps.select(*by, F.col(score).alias("threshold"), tp.alias("tp"), (pred - tp).alias("fp"),
                     F.col("pos_eq"), (F.col("n_eq") - F.col("pos_eq")).alias("neg_eq"),
                     F.col("pos_lt"), (F.col("n_lt") - F.col("pos_lt")).alias("neg_lt"),
                     F.col("pos_tot"), (F.col("n_tot") - F.col("pos_tot")).alias("neg_tot"))


def pr_points(df: DataFrame, y: str, score: str, by: list[str] | None = None) -> DataFrame:
    """H-3: precision / recall at every distinct threshold, plus the baseline rate."""
    t = threshold_table(df, y, score, by)
    return t.select(*(by or []), "threshold", "tp", "fp",
                    (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                    F.when(F.col("pos_tot") > 0, F.col("tp") / F.col("pos_tot")).alias("recall"),
                    (F.col("pos_tot") / (F.col("pos_tot") + F.col("neg_tot"))).alias("baseline"))


def average_precision(df: DataFrame, y: str, score: str, by: list[str] | None = None,
                      out: str = "average_precision") -> DataFrame:
    """M-S7: step-wise AP = Σ_t (ΔR_t) · P_t over distinct thresholds (sklearn's)."""
    by = list(by or [])
    t = threshold_table(df, y, score, by)
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    term = F.when(F.col("pos_tot") > 0, F.col("pos_eq") / F.col("pos_tot") * prec)
    return t.groupBy(*by).agg(F.sum(term).alias(out))


def average_precision_at_hand(y: np.ndarray, p: np.ndarray) -> float | None:
    """:func:`average_precision` of scores that one task holds; None without a positive row."""
    order = np.argsort(-p, kind="stable")
    last = np.flatnonzero(np.diff(p[order], append=np.nan) != 0)         # of each distinct threshold
    tp = np.cumsum(y[order] == 1)[last]
    if not len(tp) or not tp[-1]:
        return None
    return float((np.diff(tp, prepend=0) / tp[-1] * (tp / (last + 1))).sum())


def roc_auc(df: DataFrame, y: str, score: str, by: list[str] | None = None,
            out: str = "roc_auc") -> DataFrame:
    """M-S8: ROC AUC as the Mann-Whitney statistic (ties count one half).

    NULL when a class is empty (sklearn raises).
    """
    by = list(by or [])
    t = threshold_table(df, y, score, by)
    neg_below = F.col("neg_tot") - F.col("neg_lt") - F.col("neg_eq")
    num = F.sum(F.col("pos_eq") * (neg_below + 0.5 * F.col("neg_eq")))
    den = F.first(F.col("pos_tot") * F.col("neg_tot"))
    return t.groupBy(*by).agg(F.when(den > 0, num / den).alias(out))


def precision_at_k(df: DataFrame, y: str, score: str, row_id: str) -> DataFrame:
    """M-S9: precision@K and recall@K with K = number of positives.

    Rows are ranked by score descending then ``row_id`` ascending (total order).
    One distributed prefix pass over the distinct scores gives, for every score,
    the rows above it; scores whose whole tie group lies inside the top K
    contribute all their positives. Only the single boundary score (the tie
    group that straddles rank K) needs a second prefix pass, by id, over its
    own rows. NULL when K = 0.
    """
    yv = _y(y)
    ps = prefix_sums(df, [], score, {"pos": yv}, descending=True)
    k = F.col("pos_tot")
    inside = ps.where(F.col("n_lt") + F.col("n_eq") <= k)
    full = inside.agg(F.coalesce(F.sum("pos_eq"), F.lit(0.0)).alias("tp"))
    boundary = ps.where((F.col("n_lt") < k) & (k < F.col("n_lt") + F.col("n_eq"))) \
        .select(F.col(score).alias("_bs"), (k - F.col("n_lt")).alias("_take"))
    kk = ps.agg(F.coalesce(F.max("pos_tot"), F.lit(0.0)).alias("k"))
    tp = full.select("tp").scalar()
    # at most one boundary score: its value and how many of its rows are in the top K
    b = boundary.first()
    if b is not None:
        tie_rows = df.where(F.col(score) == F.lit(b["_bs"])).select(F.col(row_id), yv.alias("_yv"))
        within = prefix_sums(tie_rows, [], row_id, {"pos": F.col("_yv")})
        part = within.where(F.col("n_lt") < F.lit(b["_take"])).agg(
            F.coalesce(F.sum("pos_eq"), F.lit(0.0)).alias("tp"))
        tp = tp + part.select("tp").scalar()
    out = kk.select(F.col("k").cast("long").alias("k"), tp.alias("_tp"))
    kc = F.col("k")
    return out.select("k", F.when(kc > 0, F.col("_tp") / kc).alias("precision_at_k"),
                      F.when(kc > 0, F.col("_tp") / kc).alias("recall_at_k"))


def brier(df: DataFrame, y: str, p: str, out: str = "brier") -> DataFrame:
    """M-S10: mean squared error of a probability against the 0/1 label."""
    return df.agg(F.avg(F.pow(F.col(p) - _y(y), 2)).alias(out))


def baseline_rate(df: DataFrame, y: str, out: str = "baseline_rate") -> DataFrame:
    """M-S17: the random-classifier baseline = positive rate."""
    return df.agg(F.avg(_y(y)).alias(out))


def class_weights(df: DataFrame, y: str, out: str = "weight") -> DataFrame:
    """M-S3: balanced weight n / (2 · n_c) per row, plus ``pos_weight`` = neg / max(pos, 1).

    The class counts come from one aggregate and are attached as scalar
    subqueries (two numbers), so no join is needed.
    """
    yv = F.col(y).cast("int")
    counts = df.agg(F.count("*").alias("_n"), F.count_if(yv == 1).alias("_pos"))
    n, pos = counts.select("_n").scalar(), counts.select("_pos").scalar()
    neg = n - pos
    w = F.when(yv == 1, n / (2.0 * pos)).otherwise(n / (2.0 * neg))
    return df.withColumn(out, w).withColumn("pos_weight", neg / F.greatest(pos, F.lit(1)))


def grouped_folds(df: DataFrame, group: str, y: str, k: int = 5, seed: int = 42,
                  order: str = "hash", out: str = "fold") -> DataFrame:
    """M-S12: grouped, stratified folds — a group never spans two folds.

    Group label = max(y). Within each label class, groups are numbered in a
    pseudo-random order (``xxhash64(group, seed)``) or by name (``order='name'``)
    and dealt round-robin: fold = (rank - 1) mod k. Ranks come from distributed
    prefix sums (no class-wide window).
    """
    yv = F.col(y).cast("int")
    g = df.groupBy(group).agg(F.max(yv).alias("_label"))
    okey = F.xxhash64(F.col(group).cast("string"), F.lit(seed)) if order == "hash" \
        else F.col(group)
    g = g.withColumn("_okey", okey)
    ranks = prefix_sums(g, ["_label"], "_okey").select("_label", "_okey", F.col("n_lt").alias("_r"))
    folds = g.join(ranks, ["_label", "_okey"], "left").select(
        F.col(group).alias("_g"), (F.coalesce("_r", F.lit(0)).cast("long") % k).cast("int").alias(out))
    # a NULL group is a group of its own
    return df.join(folds, df[group].eqNullSafe(folds["_g"]), "left").drop("_g")


def model_comparison(df: DataFrame, y: str, scores: dict[str, str]) -> DataFrame:
    """M-S14: one metric row per model, sorted by PR-AUC (best first)."""
    rows = None
    for name, col in scores.items():
        ap = average_precision(df, y, col)
        auc = roc_auc(df, y, col)
        r = ap.select(F.lit(name).alias("model"), "average_precision").join(
            auc.select(F.lit(name).alias("model"), "roc_auc"), "model")
        rows = r if rows is None else rows.unionByName(r)
    w = Window.orderBy(F.col("average_precision").desc(), F.col("model"))
    return rows.withColumn("rank", F.row_number().over(w))


def compare_scores(scores: DataFrame, model: str, y: str, p: str) -> DataFrame:
    """M-S14 over a long table (model, y, p) of all models' scores: average precision, ROC AUC and Brier
    score of each from shared passes, ranked by average precision (ties by name)."""
    rows = average_precision(scores, y, p, [model]).join(roc_auc(scores, y, p, [model]), model) \
        .join(scores.groupBy(model).agg(F.avg(F.pow(F.col(p) - _y(y), 2)).alias("brier")), model)
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(F.col("average_precision").desc(), F.col(model))))
