"""Dated promotion target and career labels (D-2, D-3, D-7, G-A4, G-A5, G-A7, G-A8).

The target is leak-free: a feeder-league row is positive only when the player's
first top-league match comes strictly after that row and at most ``horizon``
months later. Everything is one lazy plan: a ``min`` aggregate per player
(partial aggregation, skew-safe) joined back behind a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import add_months_keep_time, parse_ts, strip_unicode
from .joins import join_small


def as_timestamp(df: DataFrame, col: str):
    """Column ``col`` as a timestamp: kept when already one, else parsed (NULL if bad)."""
    dt = df.schema[col].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.col(col)
    if isinstance(dt, T.DateType):
        return F.col(col).cast("timestamp")
    return parse_ts(col)


def debut_dates(df: DataFrame, roles: C.Roles = C.DEFAULT_ROLES,
                out: str = "debut") -> DataFrame:
    """G-A4: first parseable top-league date per player."""
    d = as_timestamp(df, roles.date)
    return (df.where(F.col(roles.league) == F.lit(roles.top))
            .select(F.col(roles.player), d.alias("_d"))
            .where(F.col("_d").isNotNull() & F.col(roles.player).isNotNull())
            .groupBy(roles.player).agg(F.min("_d").alias(out)))


def attach_lookup(df: DataFrame, dim: DataFrame, key: str | list[str],
                  how: str = "left") -> DataFrame:
    """D-2: dictionary lookup join (NULL when absent); broadcast only if proven small."""
    return join_small(df, dim, key, how)


def dated_target(df: DataFrame, horizon_months: int = C.HORIZON_MONTHS,
                 roles: C.Roles = C.DEFAULT_ROLES, keep_debut: bool = False) -> DataFrame:
    """D-3: TRUE iff feeder row, debut known, row date known and
    ``date < debut <= date + horizon``; never NULL."""
    deb = debut_dates(df, roles, "_debut")
    j = attach_lookup(df, deb, roles.player)
    d = as_timestamp(df, roles.date)
    cond = (F.col(roles.league).isin(list(roles.feeders))
            & F.col("_debut").isNotNull() & d.isNotNull()
            & (F.col("_debut") > d)
            & (F.col("_debut") <= add_months_keep_time(d, horizon_months)))
    out = j.withColumn(roles.target, F.coalesce(cond, F.lit(False)))
    return out.withColumnRenamed("_debut", "debut") if keep_debut else out.drop("_debut")


def target_summary(df: DataFrame, roles: C.Roles = C.DEFAULT_ROLES) -> DataFrame:
    """G-A5: positive rows, positive players, feeder players, feeder rows (one row)."""
    feeder = F.col(roles.league).isin(list(roles.feeders))
    pos = F.col(roles.target)
    return df.agg(
        F.count_if(pos).alias("positive_rows"),
        F.count_distinct(F.when(pos, F.col(roles.player))).alias("positive_players"),
        F.count_distinct(F.when(feeder, F.col(roles.player))).alias("feeder_players"),
        F.count_if(feeder).alias("feeder_rows"),
    )


def career_map(df: DataFrame, player: str, year: str, league: str,
               out: str = "leagues") -> DataFrame:
    """G-A7: player -> year -> sorted set of leagues; blank values dropped, trimmed."""
    p = strip_unicode(F.col(player).cast("string"))
    lg = strip_unicode(F.col(league).cast("string"))
    y = strip_unicode(F.col(year).cast("string"))
    base = df.select(p.alias(player), y.alias(year), lg.alias(league)).where(
        (F.coalesce(F.length(player), F.lit(0)) > 0)
        & (F.coalesce(F.length(league), F.lit(0)) > 0)
        & (F.coalesce(F.length(year), F.lit(0)) > 0))
    return base.groupBy(player, year).agg(F.array_sort(F.collect_set(league)).alias(out))


def career_map_nested(cm: DataFrame, player: str, year: str, leagues: str = "leagues") -> DataFrame:
    """G-A7 nested form: one row per player with ``map<year, array<league>>``.

    A player's map has one entry per year, so the collected list is bounded by
    the number of years (not by the number of matches).
    """
    return cm.groupBy(player).agg(F.map_from_entries(F.array_sort(
        F.collect_list(F.struct(F.col(year), F.col(leagues))))).alias("career"))


def promotion_label(df: DataFrame, player: str, year: str, league: str,
                    top: str = C.TOP_LEAGUE, feeders=C.FEEDER_LEAGUES,
                    out: str = "promoted") -> DataFrame:
    """G-A8: promoted iff some top-league year >= the first feeder year."""
    y = F.col(year).cast("int")
    return df.groupBy(player).agg(F.coalesce(
        F.max(F.when(F.col(league) == F.lit(top), y))
        >= F.min(F.when(F.col(league).isin(list(feeders)), y)), F.lit(False)).alias(out))


def cross_check(declared: DataFrame, dated: DataFrame, key: str) -> DataFrame:
    """D-7: counts of declared (A), confirmed (A ∩ B) and undatable (A − B) entities."""
    a = declared.select(key).where(F.col(key).isNotNull()).distinct()
    b = dated.select(F.col(key).alias("_b"), F.lit(True).alias("_in_b")).where(
        F.col("_b").isNotNull()).distinct()
    j = a.join(b, a[key] == b["_b"], "left")
    return j.agg(
        F.count("*").alias("declared"),
        F.count_if(F.col("_in_b")).alias("confirmed"),
        F.count_if(F.col("_in_b").isNull()).alias("undatable"),
    )
