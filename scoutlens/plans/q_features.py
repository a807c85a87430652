"""Queries: participation, per-split stats, min games, z-scores, top players."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features, rank
from . import bindings as B
from . import flows
from .catalog import finish, query, sql_finish

W = B.with_ctes
FC = flows.FEATURE_CTES


@query("kill_participation", sql_finish(W(
    "SELECT gameid, teamname, playername, position, killparticipation FROM mp",
    *FC[:4]), ["killparticipation"]))
def kill_participation(spark, d):
    m = features.kill_participation(flows.clean_match(spark, d), B.MATCH_ROLES)
    return finish(m.select("gameid", "teamname", "playername", "position", "killparticipation"))


@query("team_total_back", W(
    "SELECT gameid, teamname, kills, CAST(coalesce(sum(kills) OVER (PARTITION BY gameid, teamname), 0) "
    "AS DOUBLE) AS team_kills FROM m", ("m", B.M_SQL)))
def team_total_back(spark, d):
    m = B.match(spark, d)
    out = features.attach_group_total(m, ["gameid", "teamname"], "kills", "team_kills")
    return finish(out.select("gameid", "teamname", "kills", F.col("team_kills").cast("double")))


@query("player_split_stats", sql_finish(W("SELECT * FROM agg", *FC[:5]),
                                        ["win_rate", "kills", "assists", "killparticipation",
                                         "dpm", "vspm"]))
def player_split_stats(spark, d):
    return finish(flows.feature_rows(spark, d))


@query("min_games_filter", sql_finish(W("SELECT * FROM fm", *FC[:6]),
                                      ["win_rate", "kills", "assists", "killparticipation",
                                       "dpm", "vspm"]))
def min_games_filter(spark, d):
    return finish(features.min_games(flows.feature_rows(spark, d)))


@query("peer_zscores", sql_finish(W("SELECT * FROM f", *FC), flows.F_DOUBLES))
def peer_zscores(spark, d):
    return finish(flows.feature_table(spark, d))


TOP_SQL = W("""
SELECT playername, league, _source_year, position, dpm_zscore, games_played FROM (
  SELECT *, row_number() OVER (PARTITION BY playername
           ORDER BY dpm_zscore DESC NULLS LAST, league, _source_year, position) AS rn FROM f)
WHERE rn = 1
ORDER BY dpm_zscore DESC NULLS LAST, playername, league, _source_year, position LIMIT 20
""", *FC)


@query("top_players", sql_finish(TOP_SQL, ["dpm_zscore"]))
def top_players(spark, d):
    f = flows.feature_table(spark, d).select("playername", "league", "_source_year", "position",
                                             "dpm_zscore", "games_played")
    top = rank.top_players(f, ["playername"], "dpm_zscore", 20,
                           ["league", "_source_year", "position"])
    return finish(top.select("playername", "league", "_source_year", "position",
                             "dpm_zscore", "games_played"))
