"""Registry of named queries (``queries()``) and their DuckDB oracles (``oracle_sql()``).

Query modules register with :func:`query`; importing :mod:`scoutlens.plans`
loads all of them. Outputs go through :func:`finish` so both engines agree on
representation: doubles rounded to 6 decimals, timestamps as ISO text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
DIGITS = 6


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key`` (+ oracle SQL)."""

    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round doubles (signed zero folded to 0.0), render timestamps as text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            r = F.round(c.cast("double"), digits)
            c = F.when(r == 0, F.lit(0.0)).otherwise(r)      # no signed zero
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def sql_finish(sql: str, doubles=(), stamps=(), digits: int = DIGITS) -> str:
    """Wrap an oracle query: round the listed doubles, format the listed timestamps."""
    rep = [f'CASE WHEN round(CAST("{c}" AS DOUBLE), {digits}) = 0 THEN 0.0::DOUBLE '
           f'ELSE round(CAST("{c}" AS DOUBLE), {digits}) END AS "{c}"' for c in doubles]
    rep += [f"strftime(\"{c}\", '%Y-%m-%d %H:%M:%S') AS \"{c}\"" for c in stamps]
    if not rep:
        return sql
    return f"SELECT * REPLACE ({', '.join(rep)}) FROM ({sql}) _q"
