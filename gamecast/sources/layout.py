"""Games on a season layout, with key tables beside them (A2, A3, E7, E8 at scale).

A search for a player, a team or a season reads every box of every game unless
the files say what they hold. Here games are written once as

    games/season=<start year>/     1 October to 30 September, so every game has a season
    players/, teams/               (player | abbreviation, season, game_id), clustered by the name

A search by name reads the key table (its files are clustered, so Parquet's
statistics skip most of them), and then only the seasons and games it names. A
search by season, or a table of searches, prunes the season folders, the latter
at run time.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.rows import game_summary, player_rows, team_rows
from ..operators.search import SEASON_START_MONTH, search_games, season_window
from .games import read_games

SEASON = "season"
MAX_SEASONS = 10_000      # more start years than a calendar has: a bound for what a search by name brings to the driver


def season_start(date: str | Column = "date") -> Column:
    """Start year of the twelve months from 1 October that a date falls in."""
    d = F.col(date) if isinstance(date, str) else date
    return (F.year(d) - F.when(F.month(d) >= SEASON_START_MONTH, 0).otherwise(1)).cast("int")


def write_season_games(games: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the games and their key tables below `path`. Every task writes its own games into the season folders, so no
    game is shuffled and a long season is cut over the tasks."""
    spark = games.sparkSession
    games.withColumn(SEASON, season_start()).write.mode(mode).partitionBy(SEASON).parquet(f"{path}/games")
    written = read_games(spark, f"{path}/games", core=True, extra=[SEASON])
    for name, rows, key in (("players", player_rows(written), "player"), ("teams", team_rows(written), "abbreviation")):
        # equal rows meet in one range, so that they are told apart without a shuffle of their own
        keys = rows.select(key, season_start().alias(SEASON), "game_id").repartitionByRange(key, SEASON, "game_id").distinct()
        keys.sortWithinPartitions(key, SEASON).write.mode(mode).parquet(f"{path}/{name}")


@dataclass
class SeasonGames:
    """Games of a season layout: `games` has the folder column `season`, the key tables have (name, season, game_id)."""
    games: DataFrame
    players: DataFrame
    teams: DataFrame

    def _named(self, keys: DataFrame, column: str, names: Iterable[str]) -> DataFrame:
        """The games that the key table lists for `names`: only their seasons are read."""
        listed = keys.where(F.col(column).isin(list(names)))
        seasons = [r[SEASON] for r in listed.select(SEASON).distinct().limit(MAX_SEASONS).collect()]
        if not seasons:
            return self.games.where(F.lit(False))
        return (self.games.where(F.col(SEASON).isin(seasons))
                .join(listed.select(SEASON, "game_id").distinct(), [SEASON, "game_id"], "left_semi"))

    def player_rows(self, names: Iterable[str], stats: bool = False) -> DataFrame:
        """`rows.player_rows` of named players."""
        names = list(names)
        return player_rows(self._named(self.players, "player", names), players=names, stats=stats)

    def team_rows(self, abbrs: Iterable[str]) -> DataFrame:
        """`rows.team_rows` of named teams."""
        abbrs = list(abbrs)
        return team_rows(self._named(self.teams, "abbreviation", abbrs), abbrs=abbrs)

    def search(self, home: str, away: str, season: str, limit: int = 20, project=None) -> DataFrame:
        """`search.search_games` within a season "Y1-Y2"; only that season's folder is read."""
        first = int(season.split("-")[0])
        return search_games(self.games.where(F.col(SEASON) == first), home, away, season=season, limit=limit, project=project)

    def search_batch(self, searches: DataFrame, keys: list[str], limit: int = 20) -> DataFrame:
        """E7 for a table of searches (keys, home, away, season = start year), within [1 Oct, 30 Apr) of their season.

        The folders that no search asks for are pruned while the query runs.
        """
        g = game_summary_with_season(self.games)
        start, end = season_window(F.concat_ws("-", F.col(SEASON).cast("string"), (F.col(SEASON) + 1).cast("string")))
        s = searches.select(*dict.fromkeys([*keys, "home", "away", SEASON]), start.alias("start"), end.alias("end"))
        j = s.join(g, (g["home_abbr"] == s["home"]) & (g["away_abbr"] == s["away"]) & (g["_season"] == s[SEASON])
                   & (g["date"] >= s["start"]) & (g["date"] < s["end"])).drop("_season", "start", "end")
        w = Window.partitionBy(*keys).orderBy("date", "game_id")
        return j.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def game_summary_with_season(games: DataFrame) -> DataFrame:
    """`rows.game_summary` with the folder column, as `_season`."""
    return game_summary(games, F.col(SEASON).alias("_season"))


def read_season_games(spark: SparkSession, path: str, core: bool = True) -> SeasonGames:
    """Games that `write_season_games` wrote."""
    games = read_games(spark, f"{path}/games", core=core, extra=[SEASON])
    keys = lambda name, column: spark.read.schema(f"{column} string, {SEASON} int, game_id bigint").parquet(f"{path}/{name}")
    return SeasonGames(games, keys("players", "player"), keys("teams", "abbreviation"))
