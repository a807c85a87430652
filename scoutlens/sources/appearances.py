"""S-A6: roster / appearance extract over landed tables.

The reference fetches rosters and per-game player lines from a wiki API; here
the landed tables are joined with equi-joins (player lines ⋈ games ⋈
tournaments), kept for a set of (league, year) pairs with a left-semi join on
the small pair list, and ordered. The HTTP client itself is not built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_small


def rosters(entries: DataFrame, tournaments: DataFrame, pairs: list[tuple[str, int]], *,
            entry_tournament: str, entry_player: str, entry_team: str, entry_role: str,
            tournament_id: str, tournament_league: str, tournament_date: str) -> DataFrame:
    """Registered players (league, year, team, player, role) of the wanted (league, year) pairs,
    each once, in that order."""
    spark = entries.sparkSession
    t = tournaments.select(F.col(tournament_id).alias("_tid"), F.col(tournament_league).alias("league"),
                           F.year(tournament_date).alias("year"))
    want = spark.createDataFrame(pairs, "league string, year int")
    t = join_small(t, want, ["league", "year"], "left_semi")    # pair list: tiny
    e = entries.select(F.col(entry_tournament).alias("_tid"), F.col(entry_team).alias("team"),
                       F.col(entry_player).alias("player"), F.col(entry_role).alias("role"))
    out = e.where(F.col("player").isNotNull()).join(t, "_tid").select("league", "year", "team", "player", "role")
    return out.distinct().orderBy("league", "year", "team", "player", "role")


def appearances(lines: DataFrame, games: DataFrame, tournaments: DataFrame,
                pairs: list[tuple[str, int]], *, line_game: str, line_player: str,
                game_id: str, game_tournament: str, game_date: str,
                tournament_id: str, tournament_league: str, line_more: dict | None = None) -> DataFrame:
    """Player appearances (player, game, league, year, date) for the wanted (league, year)
    pairs; ``line_more`` maps further output columns (team, role, champion) to line columns."""
    spark = lines.sparkSession
    g = games.select(F.col(game_id).alias("_gid"), F.col(game_tournament).alias("_tid"),
                     F.year(game_date).alias("year"), F.col(game_date).alias("date"))
    t = tournaments.select(F.col(tournament_id).alias("_tid"),
                           F.col(tournament_league).alias("league"))
    want = spark.createDataFrame(pairs, "league string, year int")
    gt = join_small(g, t, "_tid", "inner")            # games x tournaments (tournaments small)
    gt = join_small(gt, want, ["league", "year"], "left_semi")  # pair list: tiny
    more = line_more or {}
    out = lines.select(F.col(line_player).alias("player"), F.col(line_game).alias("game"),
                       *[F.col(c).alias(n) for n, c in more.items()]) \
        .join(gt, F.col("game") == F.col("_gid"), "inner")
    return out.select("player", "game", "league", "year", "date", *more).orderBy("league", "year", "player", "game")
