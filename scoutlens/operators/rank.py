"""Ranks, peak rows and top-k (W-2 … W-8).

* Peak row per entity uses ``min_by`` over a total order — an aggregate with map
  side partial aggregation, so a player with a third of the rows is reduced in
  every task before the shuffle (no per-player window).
* Per-group top-n uses ``row_number() <= n``; Spark plans a partial
  ``WindowGroupLimit`` before the shuffle, so at most n rows per group and task
  move.
* Global top-n is ``orderBy().limit()`` (TakeOrderedAndProject).
* The average-rank percentile uses the distributed prefix sums of
  :mod:`.order_stats` instead of a window over the whole position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_small
from .order_stats import average_ranks


def _order_struct(score: str, tiebreak: list[str], descending: bool = True):
    """Total order as a struct for ``min_by``: non-NULL scores first."""
    s = F.col(score)
    key = -s if descending else s
    return F.struct(s.isNull().alias("_null"), key.alias("_key"),
                    *[F.col(t).alias(f"_t{i}") for i, t in enumerate(tiebreak)])


def _sort_cols(score: str, tiebreak: list[str], descending: bool = True):
    s = F.col(score)
    return [s.desc_nulls_last() if descending else s.asc_nulls_last()] + \
        [F.col(t).asc_nulls_last() for t in tiebreak]


def percentile_rank_avg(df: DataFrame, part: list[str], score: str,
                        out: str = "score_percentile") -> DataFrame:
    """W-2: pandas ``rank(pct=True) * 100`` per partition (average rank for ties).

    NULL scores get a NULL percentile and do not count in the group size.
    """
    ranks = average_ranks(df, part, score).select(
        *part, score, (F.col("avg_rank") / F.col("n_tot") * 100).alias(out))
    # name-based equi-join: NULL keys / scores match nothing -> NULL percentile
    return join_small(df, ranks, part + [score], "left").select(*df.columns, out)


def best_per(df: DataFrame, key: list[str], score: str, tiebreak: list[str],
             descending: bool = True) -> DataFrame:
    """W-3 / U-2: the best row per ``key`` (highest score, then ``tiebreak`` asc)."""
    others = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(
        F.min_by(F.struct(*[F.col(c) for c in others]),
                 _order_struct(score, tiebreak, descending)).alias("_best"))
    return best.select(*key, *[F.col(f"_best.{c}").alias(c) for c in others]) \
        .select(*df.columns)


def top_players(df: DataFrame, key: list[str], score: str, n: int,
                tiebreak: list[str]) -> DataFrame:
    """W-4: top-n entities by score, each represented by its best row."""
    best = best_per(df, key, score, tiebreak)
    return best.orderBy(*_sort_cols(score, key + tiebreak)).limit(n)


def top_per_group(df: DataFrame, part: list[str], key: list[str], score: str, n: int,
                  tiebreak: list[str], rank_col: str = "rank") -> DataFrame:
    """W-5: top-n per group, best row per entity inside each group."""
    best = best_per(df, part + key, score, tiebreak)
    w = Window.partitionBy(*part).orderBy(*_sort_cols(score, key + tiebreak))
    return best.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def ranked(df: DataFrame, score: str, n: int, tiebreak: list[str],
           rank_col: str = "rank") -> DataFrame:
    """W-6: leaderboard — sort, keep the first n, number them 1..n.

    The numbering window runs on the n kept rows only (after the limit).
    """
    top = df.orderBy(*_sort_cols(score, tiebreak)).limit(n)
    w = Window.orderBy(*_sort_cols(score, tiebreak))
    return top.withColumn(rank_col, F.row_number().over(w))


def season_history(df: DataFrame, player_col: str, player: str, year_col: str,
                   split_col: str) -> DataFrame:
    """W-7: one player's rows, year descending then split ascending."""
    return df.where(F.col(player_col) == F.lit(player)).orderBy(
        F.col(year_col).desc(), F.col(split_col).asc())


def top_percent(pct_col: str = "score_percentile"):
    """W-8: "top X %" label value = max(100 - percentile, 1)."""
    return F.greatest(F.lit(100.0) - F.col(pct_col), F.lit(1.0))
