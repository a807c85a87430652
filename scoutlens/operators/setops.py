"""Set operations (U-1 … U-3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_aligned(*dfs: DataFrame) -> DataFrame:
    """U-1: union all by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """U-2: full-row distinct over ``cols`` (keyed "first row" is ``rank.best_per``)."""
    return (df.select(*cols) if cols else df).distinct()


def set_ops(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """U-3: the distinct keys in both sets and in ``a`` only, as (kind, key) rows."""
    ka = a.select(key).where(F.col(key).isNotNull()).distinct()
    kb = b.select(key).where(F.col(key).isNotNull()).distinct()
    both = ka.join(kb, key, "left_semi").withColumn("kind", F.lit("both"))
    only_a = ka.join(kb, key, "left_anti").withColumn("kind", F.lit("a_only"))
    return both.unionByName(only_a).select("kind", key)
