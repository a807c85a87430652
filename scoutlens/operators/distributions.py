"""Distribution tables behind the reference's charts (H-1 … H-6), computed on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import attach_scalars, join_small
from .order_stats import exact_quantiles
from .rank import best_per


def histogram(df: DataFrame, col: str, bins: int, by: list[str] | None = None) -> DataFrame:
    """H-1: equal-width histogram over [min, max] (max in the last bin), per group.

    Returns ``by..., bin, lo, hi, n``; empty bins are not emitted. When
    min == max the range is widened by 0.5 each side (numpy's rule).
    """
    by = list(by or [])
    x = F.col(col).cast("double")
    base = df.where(x.isNotNull()).select(*by, x.alias("_x"))
    rng = base.groupBy(*by).agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx"))
    rng = rng.select(*by,
                     F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5)
                     .otherwise(F.col("_mn")).alias("_lo"),
                     F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5)
                     .otherwise(F.col("_mx")).alias("_hi"))
    j = join_small(base, rng, by, "inner") if by else attach_scalars(base, rng)
    b = F.least(F.floor((F.col("_x") - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))),
                F.lit(bins - 1)).cast("int")
    counts = j.groupBy(*by, b.alias("bin"), "_lo", "_hi").agg(F.count("*").alias("n"))
    w = (F.col("_hi") - F.col("_lo")) / bins
    return counts.select(*by, "bin", (F.col("_lo") + F.col("bin") * w).alias("lo"),
                         (F.col("_lo") + (F.col("bin") + 1) * w).alias("hi"), "n")


def summary_line(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """H-1 overlay: mean and exact median per group."""
    by = list(by or [])
    mean = df.groupBy(*by).agg(F.avg(col).alias("mean"))
    med = exact_quantiles(df, by, col, [0.5], "median").drop("p")
    return join_small(mean, med, by, "left") if by else attach_scalars(mean, med)


def boxplot(df: DataFrame, col: str, by: list[str]) -> DataFrame:
    """H-2: Q1, median, Q3, whiskers (last point within 1.5 IQR) and outlier count."""
    q = (exact_quantiles(df, by, col, [0.25, 0.5, 0.75])
         .groupBy(*by).pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q")))
    q = q.select(*by, F.col("`0.25`").alias("q1"), F.col("`0.5`").alias("median"),
                 F.col("`0.75`").alias("q3"))
    x = F.col(col)
    j = join_small(df.where(x.isNotNull()).select(*by, x), q, by, "inner")
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    return j.groupBy(*by).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(x >= lo_f, x)).cast("double").alias("whisker_lo"),
        F.max(F.when(x <= hi_f, x)).cast("double").alias("whisker_hi"),
        F.count_if((x < lo_f) | (x > hi_f)).alias("n_outliers"),
        F.count("*").alias("n"))


def profile_matrix(profiles: DataFrame, part: str, cluster: str, cols: list[str],
                   wide: bool = False) -> DataFrame:
    """H-4: (position, cluster) x feature, long (default) or pivoted wide."""
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                    for c in cols])
    long = profiles.select(part, cluster, F.inline(arr))
    if not wide:
        return long
    return long.groupBy("feature").pivot(part).agg(F.first("value"))


def radar(df: DataFrame, key: str, player, score: str, zcols: list[str],
          tiebreak: list[str], min_axes: int = 3) -> DataFrame:
    """H-6: non-NULL z-scores of the player's peak row as (axis, value); empty when
    fewer than ``min_axes`` axes remain."""
    rows = df.where(F.col(key) == F.lit(player))
    peak = best_per(rows, [key], score, tiebreak)
    arr = F.array(*[F.struct(F.lit(c).alias("axis"), F.col(c).cast("double").alias("value"))
                    for c in zcols])
    axes = peak.select(key, F.inline(arr)).where(F.col("value").isNotNull())
    n = axes.groupBy(key).agg(F.count("*").alias("_n"))
    return axes.join(n, key).where(F.col("_n") >= min_axes).drop("_n")
