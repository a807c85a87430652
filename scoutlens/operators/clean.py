"""Projection, filters and cleaning (P-C1 … P-C8).

All filters are plain predicates (pushed to the parquet scan by Catalyst when
they touch stored columns). The grouped-median imputation uses the exact,
distributed quantiles of :mod:`.order_stats` (one range sort for all imputed
columns), never a per-group window or an in-memory percentile buffer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import contains_either, normalize_key
from .joins import join_small, scalars
from .order_stats import quantile_columns

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def discover(df: DataFrame, col: str = "league", div1=C.FEEDER_DIV1_LEAGUES,
             div2=C.FEEDER_DIV2_LEAGUES, top: str = C.TOP_LEAGUE) -> DataFrame:
    """P-C1: rows per value (NULL dropped), descending, tagged with its tier."""
    tier = (F.when(F.col(col).isin(list(div1)), "div1")
            .when(F.col(col).isin(list(div2)), "div2")
            .when(F.col(col) == F.lit(top), "top").otherwise("other"))
    return (df.where(F.col(col).isNotNull()).groupBy(col).count()
            .withColumnRenamed("count", "n_rows").withColumn("tier", tier)
            .orderBy(F.col("n_rows").desc(), F.col(col)))


def target_league_set(df: DataFrame, targets: list[str], col: str = "league",
                      order_col: str | None = None) -> DataFrame:
    """Leagues kept by :func:`filter_targets` (one row per kept league).

    Exact matches first; for each target without an exact match, the first
    league (smallest ``order_col``, else smallest name) where either name
    contains the other, case-insensitive. NULL leagues never match.
    """
    spark = df.sparkSession
    tdf = spark.createDataFrame([(t,) for t in targets], "target string")
    seen = df.where(F.col(col).isNotNull())
    if order_col:
        leagues = seen.groupBy(col).agg(F.min(order_col).alias("_first"))
    else:
        leagues = seen.select(col).distinct().withColumn("_first", F.col(col))
    exact = tdf.join(leagues, tdf["target"] == leagues[col], "left_semi")
    unmatched = tdf.join(leagues, tdf["target"] == leagues[col], "left_anti")
    # non-equi match of the few unmatched targets against the distinct leagues
    partial = unmatched.join(leagues, contains_either(unmatched["target"], leagues[col]))
    picks = partial.groupBy("target").agg(
        F.min_by(F.col(col), F.struct("_first", col)).alias(col)).select(col)
    return exact.select(F.col("target").alias(col)).unionByName(picks).distinct()


def filter_targets(df: DataFrame, targets: list[str] = C.ALL_TARGET_LEAGUES,
                   col: str = "league", order_col: str | None = None) -> DataFrame:
    """P-C2: keep target leagues, exact then partial match (semi-join)."""
    keep = target_league_set(df, targets, col, order_col)
    return join_small(df, keep, col, "left_semi")


def filter_roles(df: DataFrame, col: str = "position", roles=C.POSITIONS) -> DataFrame:
    """P-C3: keep entity rows (lower(position) in the role list)."""
    return df.where(F.lower(F.col(col)).isin(list(roles)))


def select_known(df: DataFrame, wanted=C.KEY_COLUMNS, extra=("_source_year",)):
    """P-C4: project the wanted columns that exist (+ provenance); report missing.

    Returns ``(DataFrame, missing_columns)`` — a schema-only decision, no job.
    """
    have = set(df.columns)
    keep = [c for c in wanted if c in have] + [c for c in extra if c in have and c not in wanted]
    missing = [c for c in wanted if c not in have]
    return df.select(*keep), missing


def normalize_name(df: DataFrame, col: str = "playername",
                   original: str = "playername_original") -> DataFrame:
    """P-C5: keep the original, key = lower(strip(name)) with Unicode white space."""
    if col not in df.columns:
        return df
    return df.withColumn(original, F.col(col)).withColumn(col, normalize_key(F.col(col)))


def drop_missing(df: DataFrame, cols=("playername", "teamname", "league")) -> DataFrame:
    """P-C6: drop rows with a NULL identity column (those that exist)."""
    cols = [c for c in cols if c in df.columns]
    return df.dropna(subset=cols) if cols else df


def numeric_columns(df: DataFrame, exclude=("_source_year", "result")) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def _medians(df: DataFrame, keys: list[str], cols: list[str], approx: bool) -> DataFrame:
    """One row per key with the median of each column (pivoted)."""
    if approx:
        # percentile_approx keeps a bounded sketch per group (no exact order)
        return df.groupBy(*keys).agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, 10000)
                                       .alias(c) for c in cols])
    return (quantile_columns(df, keys, cols, [0.5])
            .groupBy(*keys).pivot("column", cols).agg(F.first("q")))


def impute_group_median(df: DataFrame, cols: list[str] | None = None,
                        keys=("league", "_source_year"),
                        exclude=("_source_year", "result"), approx: bool = False) -> DataFrame:
    """P-C7: NULL -> median of its (league, year) group; still NULL -> median of the
    column *after* the group fill.

    Only columns that contain NULLs are imputed (one aggregate job finds them,
    as the reference does). Medians are exact (linear interpolation) and
    computed for all imputed columns in one distributed sort; ``approx=True``
    switches to ``percentile_approx`` sketches (a data value, not interpolated).
    The input is read several times (NULL census, group medians, global
    medians, fill): pass a staged table rather than a long lineage.
    """
    keys = [k for k in keys if k in df.columns]
    cols = cols if cols is not None else numeric_columns(df, exclude)
    if not cols:
        return df
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    todo = [c for c in cols if nulls[c] > 0]
    if not todo:
        return df
    group_med = _medians(df, keys, todo, approx)
    group_med = group_med.select(*keys, *[F.col(c).alias(f"_gm_{c}") for c in todo])
    filled = join_small(df, group_med, keys, "left")
    for c in todo:
        filled = filled.withColumn(c, F.coalesce(F.col(c).cast("double"), F.col(f"_gm_{c}")))
    filled = filled.drop(*[f"_gm_{c}" for c in todo])
    left = filled.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in todo]).first()
    todo = [c for c in todo if left[c] > 0]               # groups without any value
    if not todo:
        return filled.select(*df.columns)
    glob = _medians(filled, [], todo, approx)
    # one value per imputed column, attached as lazy scalar subqueries
    g = scalars(glob)
    for c in todo:
        filled = filled.withColumn(c, F.coalesce(F.col(c), g[c].cast("double")))
    return filled.select(*df.columns)


def fill_unknown(df: DataFrame, value: str = "unknown") -> DataFrame:
    """P-C8: categorical (string) NULLs -> 'unknown'."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna(value, subset=cols) if cols else df
