"""Order statistics without a single-task window.

A window ``partitionBy(g).orderBy(v)`` sends every row of a group to one task;
with a group holding a third of all rows that task holds a third of the data.
The operators here (exact quantiles, average ranks, threshold curves) instead
compute *prefix sums over sorted values* in a distributed way:

1. combine equal ``(group, value)`` pairs with a map-side-combined aggregate, so
   a hot value never travels row by row;
2. range-partition the distinct pairs across all tasks, so a hot group spans
   many partitions (balanced: every key is now unique);
3. per partition, running sums in sorted order (Arrow batches, ``mapInPandas``),
   carried across batches;
4. the per-partition table is written as a stage table (partition ids must refer
   to one physical partitioning), then per (partition, group) totals -> a tiny table
   (at most groups + partitions rows) whose per-group running sum over
   partition ids gives each partition's offset; joined back behind a size
   check.

Every row of the result is one distinct ``(group, value)`` with, for each summed
measure ``s``: ``s_eq`` (rows at this value), ``s_lt`` (rows strictly before in
the order) and ``s_tot`` (group total). Exact quantiles, pandas-style average
ranks, precision/recall points, average precision and ROC AUC are all
closed-form in these three numbers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .joins import join_small

_V = "_v"
_PID = "_pid"


def _local_prefix(group_cols: list[str], sums: list[str]):
    """Build the per-partition running-sum function for ``mapInPandas``."""

    def fn(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        carry_key = None
        carry = np.zeros(len(sums))
        for pdf in batches:
            if pdf.empty:
                continue
            n = len(pdf)
            if group_cols:
                new = np.zeros(n, dtype=bool)
                for c in group_cols:
                    col = pdf[c]
                    prev = col.shift(1)
                    diff = col.ne(prev) & ~(col.isna() & prev.isna())
                    new |= diff.to_numpy()
                first_key = tuple(pdf[c].iloc[0] for c in group_cols)
                continues = carry_key is not None and all(
                    (a == b) or (pd.isna(a) and pd.isna(b)) for a, b in zip(first_key, carry_key)
                )
                new[0] = not continues
            else:
                new = np.zeros(n, dtype=bool)
                new[0] = carry_key is None
            seg = np.cumsum(new)
            vals = pdf[[f"{s}_eq" for s in sums]].to_numpy(dtype="float64")
            incl = pd.DataFrame(vals).groupby(seg).cumsum().to_numpy()
            excl = incl - vals
            if not new[0]:
                first_seg = seg == seg[0]
                excl[first_seg] += carry
            for i, s in enumerate(sums):
                pdf[f"{s}_loc"] = excl[:, i]
            pdf[_PID] = pid
            last = excl[-1] + vals[-1]
            carry = last
            carry_key = tuple(pdf[c].iloc[-1] for c in group_cols) if group_cols else ()
            yield pdf

    return fn


def prefix_sums(df: DataFrame, group_cols: list[str], order_col: str,
                sums: dict | None = None, descending: bool = False,
                num_partitions: int | None = None) -> DataFrame:
    """Per distinct (group, value): ``s_eq``, ``s_lt``, ``s_tot`` for each measure.

    ``sums`` maps a name to a numeric Column expression; ``n`` (row count) is
    always included. Rows whose ``order_col`` is NULL are ignored (pandas ranks
    and quantiles skip missing values). ``descending`` orders the values high
    to low, so ``s_lt`` sums the rows with a strictly *larger* value.
    """
    sums = dict(sums or {})
    names = ["n"] + [s for s in sums if s != "n"]
    exprs = [F.lit(1).cast("double").alias("n")] + [
        F.coalesce(sums[s].cast("double"), F.lit(0.0)).alias(s) for s in names[1:]
    ]
    value = F.col(order_col)
    if isinstance(df.schema[order_col].dataType, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)               # NaN is missing, as in pandas
    base = df.select(*[F.col(c) for c in group_cols], value.alias(_V), *exprs) \
        .where(F.col(_V).isNotNull())
    vorder = F.col(_V).desc() if descending else F.col(_V).asc()
    sort_keys = [F.col(c).asc() for c in group_cols] + [vorder]
    # equal (group, value) pairs are combined map-side first, so a hot value
    # (say a third of all rows with value 0) collapses before any shuffle
    distinct = base.groupBy(*group_cols, _V).agg(*[F.sum(s).alias(f"{s}_eq") for s in names])
    # distinct pairs are then range-partitioned: a hot group spans many tasks
    if num_partitions:
        ranged = distinct.repartitionByRange(num_partitions, *sort_keys)
    else:
        ranged = distinct.repartitionByRange(*sort_keys)
    agg = ranged.sortWithinPartitions(*sort_keys)
    out_schema = T.StructType(
        list(agg.schema.fields)
        + [T.StructField(f"{s}_loc", T.DoubleType()) for s in names]
        + [T.StructField(_PID, T.IntegerType())]
    )
    local = agg.mapInPandas(_local_prefix(group_cols, names), out_schema)
    # Partition ids are only meaningful for one physical evaluation (AQE may
    # coalesce the range partitions differently each time the sub-plan is
    # planned), so the per-partition table is written once as a stage table in
    # the shared folder; both the offsets and the final join read its files.
    local = materialize(local, "prefix")

    part = local.groupBy(_PID, *group_cols).agg(
        *[F.sum(f"{s}_eq").alias(f"{s}_part") for s in names])
    w_before = Window.partitionBy(*group_cols).orderBy(_PID).rowsBetween(
        Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*group_cols)
    offs = part.select(
        _PID, *group_cols,
        *[F.coalesce(F.sum(f"{s}_part").over(w_before), F.lit(0.0)).alias(f"{s}_off")
          for s in names],
        *[F.sum(f"{s}_part").over(w_all).alias(f"{s}_tot") for s in names],
    )
    # null-safe equality on the group keys
    ren = offs.select(*[F.col(c).alias(f"_o_{c}") for c in offs.columns])

    def same(r):
        cond = local[_PID] == r[f"_o_{_PID}"]
        for c in group_cols:
            cond = cond & local[c].eqNullSafe(r[f"_o_{c}"])
        return cond

    joined = join_small(local, ren, same, "inner")
    cols = [F.col(c) for c in group_cols] + [F.col(_V).alias(order_col)]
    for s in names:
        cols += [
            F.col(f"{s}_eq"),
            (F.col(f"_o_{s}_off") + F.col(f"{s}_loc")).alias(f"{s}_lt"),
            F.col(f"_o_{s}_tot").alias(f"{s}_tot"),
        ]
    return joined.select(*cols)


def exact_quantiles(df: DataFrame, group_cols: list[str], value_col: str,
                    probs: list[float], out_col: str = "q") -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / numpy default).

    Returns one row per (group, p) that has at least one non-NULL value:
    ``group..., p, out_col``. Never gathers a group in one task.
    """
    ps = prefix_sums(df, group_cols, value_col)
    p_arr = F.array(*[F.lit(float(p)) for p in probs])
    h = (F.col("n_tot") - 1) * F.col("p")
    lo, hi = F.floor(h), F.ceil(h)
    first, last = F.col("n_lt"), F.col("n_lt") + F.col("n_eq") - 1
    has_lo = (first <= lo) & (lo <= last)
    has_hi = (first <= hi) & (hi <= last)
    # only the probabilities whose rank falls on this value are unfolded
    at = lambda p, edge: (F.col("n_lt") <= edge((F.col("n_tot") - 1) * p)) \
        & (edge((F.col("n_tot") - 1) * p) < F.col("n_lt") + F.col("n_eq"))
    hits = F.filter(p_arr, lambda p: at(p, F.floor) | at(p, F.ceil))
    cand = (ps.withColumn("p", F.explode(hits))
            .withColumn("_has_lo", has_lo).withColumn("_has_hi", has_hi))
    agg = cand.groupBy(*group_cols, "p").agg(
        F.min(F.when(F.col("_has_lo"), F.col(value_col))).alias("_vlo"),
        F.max(F.when(F.col("_has_hi"), F.col(value_col))).alias("_vhi"),
        F.first(h - F.floor(h)).alias("_frac"),
    )
    return agg.select(
        *group_cols, "p",
        (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")).alias(out_col))


def quantile_columns(df: DataFrame, group_cols: list[str], value_cols: list[str],
                     probs: list[float]) -> DataFrame:
    """Exact quantiles of several columns in one pass (unpivot, then one sort).

    Returns ``group..., column, p, q``.
    """
    long = df.select(*group_cols, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in value_cols])).alias("_kv")).select(*group_cols, "_kv.column", "_kv.value")
    return exact_quantiles(long, group_cols + ["column"], "value", probs)


def average_ranks(df: DataFrame, group_cols: list[str], value_col: str,
                  descending: bool = False) -> DataFrame:
    """pandas ``rank(method='average')`` per distinct (group, value).

    Returns ``group..., value, avg_rank, n_tot`` (ranks start at 1).
    """
    ps = prefix_sums(df, group_cols, value_col, descending=descending)
    return ps.select(*group_cols, value_col,
                     (F.col("n_lt") + (F.col("n_eq") + 1) / 2).alias("avg_rank"),
                     F.col("n_tot"))
