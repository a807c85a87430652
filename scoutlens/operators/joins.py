"""Joins whose small side is broadcast only behind a size check.

``join_small`` writes the (already aggregated) small side as a stage table in the
shared folder, counts it with a plain partial aggregate and broadcasts it only
when the count proves it fits; otherwise it falls back to a shuffle join, where
AQE's skew-join handling splits any hot key of the large side. The side is
computed once whatever its size, nothing is held in memory, and a lost executor
only means that the stage is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# Broadcast at most this many rows / estimated bytes (overridable per session
# with ``spark.scoutlens.broadcastMaxRows`` / ``spark.scoutlens.broadcastMaxBytes``).
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    try:
        v = df.sparkSession.conf.get(key)
    except Exception:  # noqa: BLE001 - unset key
        v = None
    return int(v) if v else default


def broadcast_limit(df: DataFrame) -> int:
    return _conf_int(df, "spark.scoutlens.broadcastMaxRows", DEFAULT_BROADCAST_MAX_ROWS)


def row_width(schema: T.StructType) -> int:
    """Rough upper estimate of one row's size in bytes, from its schema."""
    total = 0
    for f in schema.fields:
        dt = f.dataType
        if isinstance(dt, T.StringType):
            total += 48
        elif isinstance(dt, (T.ArrayType, T.MapType)):
            total += 256
        elif isinstance(dt, T.StructType):
            total += row_width(dt)
        else:
            total += 8
    return max(total, 8)


def fits_broadcast(small: DataFrame, max_rows: int | None = None) -> bool:
    """True when ``small`` provably fits a broadcast: at most ``max_rows`` rows and at
    most ``spark.scoutlens.broadcastMaxBytes`` estimated bytes (one count per task)."""
    limit = broadcast_limit(small) if max_rows is None else max_rows
    max_bytes = _conf_int(small, "spark.scoutlens.broadcastMaxBytes", DEFAULT_BROADCAST_MAX_BYTES)
    limit = min(limit, max_bytes // row_width(small.schema))
    return small.agg(F.count(F.lit(1))).first()[0] <= limit


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               max_rows: int | None = None, stage: bool = True) -> DataFrame:
    """Join ``big`` with ``small``; broadcast ``small`` only if its size is proven.

    ``on`` names columns, or is a function of the staged side giving the condition.
    ``stage=False``: ``small`` is a table that is cheap to read twice."""
    if stage:
        small = materialize(small, "side")
    cond = on(small) if callable(on) else on
    return big.join(F.broadcast(small) if fits_broadcast(small, max_rows) else small, cond, how)


def scalars(one_row: DataFrame) -> dict:
    """Columns of a one-row aggregate as lazy scalar subqueries, by name.

    Used instead of a keyless join to attach global statistics to every row;
    Spark merges the subqueries into one aggregate job.
    """
    packed = one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias("_s"))
    sq = packed.scalar()        # one subquery for all columns (reused across fields)
    return {c: sq.getField(c) for c in one_row.columns}


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add every column of a one-row aggregate to each row of ``df``."""
    for name, col in scalars(one_row).items():
        df = df.withColumn(name, col)
    return df
