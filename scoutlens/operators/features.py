"""Player-split features: participation, per-split aggregate, min games, z-scores.

Shape of the work at scale: every group statistic is a ``groupBy().agg()`` (map
side partial aggregation, so a hot league / player never lands whole in one
task) joined back to the rows, never a whole-group window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import all_not_null, clip, safe_ratio
from .joins import join_small


def attach_group_total(df: DataFrame, keys: list[str], col: str, out: str,
                       broadcast: bool = False) -> DataFrame:
    """D-1: ``sum(col)`` per ``keys`` attached to every row (left, many-to-one).

    pandas sums skip missing values and give 0 for an all-missing group; rows
    with a NULL key get 0 as well (their group is dropped by pandas, the merge
    leaves NaN, and the participation rule maps it to 0). The key domain
    (games x teams) grows with the data, so by default this is a shuffle join
    (AQE splits a hot key) rather than a broadcast.
    """
    totals = df.groupBy(*keys).agg(F.coalesce(F.sum(col), F.lit(0)).alias(out))
    totals = totals.where(all_not_null(keys))
    if broadcast:
        return join_small(df, totals, keys, "left")
    return df.join(totals, keys, "left")


def kill_participation(df: DataFrame, roles: C.Roles = C.DEFAULT_ROLES,
                       out: str = "killparticipation") -> DataFrame:
    """G-A1: (kills + assists) / team kills, 0 when team kills <= 0, clipped to [0, 1]."""
    keys = [roles.gameid, roles.team]
    t = attach_group_total(df, keys, roles.kills, "_team_kills")
    ratio = safe_ratio(F.col(roles.kills) + F.col(roles.assists), F.col("_team_kills"), None)
    kp = F.when(F.coalesce(F.col("_team_kills"), F.lit(0)) > 0, clip(ratio, 0.0, 1.0)) \
        .otherwise(F.lit(0.0))
    return t.withColumn(out, kp.cast("double")).drop("_team_kills")


def aggregate_players(df: DataFrame, keys: list[str] | None = None,
                      mean_cols: list[str] | None = None,
                      roles: C.Roles = C.DEFAULT_ROLES) -> DataFrame:
    """G-A2: one row per player x split.

    games_played = count(non-NULL gameid); win_rate = mean(result);
    champion_pool_size = count distinct champion; target = any(target);
    original name = first non-NULL by (date, gameid); mean of each stat.
    Rows with a NULL key are dropped first (pandas ``groupby`` does).
    """
    keys = list(keys or roles.split_keys)
    cols = set(df.columns)
    mean_cols = [c for c in (mean_cols if mean_cols is not None else C.MEAN_COLUMNS)
                 if c in cols]
    base = df.dropna(subset=keys)
    aggs = [
        F.count(roles.gameid).alias("games_played"),
        F.avg(roles.result).alias("win_rate"),
    ]
    if roles.target in cols:
        aggs.append(F.coalesce(F.bool_or(roles.target), F.lit(False)).alias(roles.target))
    if roles.original in cols:
        order = F.when(F.col(roles.original).isNotNull(),
                       F.struct(F.col(roles.date), F.col(roles.gameid)))
        aggs.append(F.min_by(roles.original, order).alias(roles.original))
    aggs += [F.avg(c).alias(c) for c in mean_cols]
    # champions are counted apart: in one aggregate Spark would group all of them by key and champion, and
    # shuffle the other sums at nearly one row per match; here only (key, champion) pairs travel
    pairs = base.select(*keys, roles.champion).where(F.col(roles.champion).isNotNull()).distinct()
    pool = pairs.groupBy(*keys).agg(F.count("*").alias("champion_pool_size"))
    first = ["games_played", "win_rate"]
    out = base.groupBy(*keys).agg(*aggs).join(pool, keys, "left")
    return out.select(*keys, *first, F.coalesce("champion_pool_size", F.lit(0).cast("long")).alias("champion_pool_size"),
                      *[c for c in out.columns if c not in (*keys, *first, "champion_pool_size")])


def min_games(df: DataFrame, n: int = C.MIN_GAMES, col: str = "games_played") -> DataFrame:
    """G-A3: keep representative rows (``col >= n``)."""
    return df.where(F.col(col) >= n)


def add_zscores(df: DataFrame, cols: list[str] | None = None,
                keys: list[str] | None = None, suffix: str = "_zscore",
                roles: C.Roles = C.DEFAULT_ROLES) -> DataFrame:
    """W-1: peer-group z-score with the *sample* std.

    z = (x - mean) / std when std > 0, else 0; a NULL result is 0. All features
    share one aggregation (one shuffle with partial aggregation) and one join;
    the peer-group table is bounded by the group domain and broadcast only after
    its size is checked.
    """
    keys = list(keys or roles.peer_keys)
    cols = [c for c in (cols if cols is not None else C.ZSCORE_BASE) if c in df.columns]
    if not cols:
        return df
    stats = df.groupBy(*keys).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in cols],
        *[F.stddev_samp(c).alias(f"_s_{c}") for c in cols],
    ).where(all_not_null(keys))
    # NULL-key rows never join (pandas excludes them from groups) -> z = 0
    out = join_small(df, stats, keys, "left")
    for c in cols:
        m, s = F.col(f"_m_{c}"), F.col(f"_s_{c}")
        z = F.when(s > 0, (F.col(c) - m) / s).otherwise(F.lit(0.0))
        out = out.withColumn(f"{c}{suffix}", F.coalesce(z, F.lit(0.0)))
    return out.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def build_features(match: DataFrame, keys: list[str] | None = None,
                   peer_keys: list[str] | None = None, min_n: int = C.MIN_GAMES,
                   roles: C.Roles = C.DEFAULT_ROLES) -> DataFrame:
    """Participation -> per-split aggregate -> min games -> z-scores (§3.2)."""
    m = match
    if "killparticipation" not in m.columns and roles.kills in m.columns \
            and roles.assists in m.columns:
        m = kill_participation(m, roles)
    agg = aggregate_players(m, keys, roles=roles)
    return add_zscores(min_games(agg, min_n), keys=peer_keys, roles=roles)
