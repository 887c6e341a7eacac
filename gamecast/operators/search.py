"""Game search by home team, away team and date range or season."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import season_label, season_value

SEASON_START_MONTH, SEASON_START_DAY = 10, 1   # fixed value: seasons open on 1 October
SEASON_END_MONTH, SEASON_END_DAY = 4, 30       # fixed value: and close before 30 April


def _ts(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        v = dt.datetime.fromisoformat(v)
    if isinstance(v, dt.date) and not isinstance(v, dt.datetime):
        v = dt.datetime(v.year, v.month, v.day)
    # from text: a wall-clock literal, independent of any time zone
    return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")


def season_window(label: str | Column) -> tuple[Column, Column]:
    """E8: "Y1-Y2" -> [1 October Y1, 30 April Y2) as NTZ timestamps (end exclusive)."""
    lab = F.lit(label) if isinstance(label, str) else label
    parts = F.split(lab, "-")
    y1 = F.get(parts, 0).cast("int")
    y2 = F.get(parts, 1).cast("int")
    z = F.lit(0)
    start = F.make_timestamp_ntz(y1, F.lit(SEASON_START_MONTH), F.lit(SEASON_START_DAY), z, z, z)
    end = F.make_timestamp_ntz(y2, F.lit(SEASON_END_MONTH), F.lit(SEASON_END_DAY), z, z, z)
    return start, end


def match_teams(home: str | Column, away: str | Column) -> Column:
    """`teams` holds {home abbr, home = true} and {away abbr, home = false}."""
    h = F.lit(home) if isinstance(home, str) else home
    a = F.lit(away) if isinstance(away, str) else away
    return (F.exists("teams", lambda t: (t["abbreviation"] == h) & t["home"])
            & F.exists("teams", lambda t: (t["abbreviation"] == a) & ~t["home"]))


def search_games(games: DataFrame, home: str, away: str, start=None, end=None,
                 season: str | None = None, limit: int = 20, project=None) -> DataFrame:
    """Games of `home` at home against `away`, start <= date < end, first
    `limit` by date (the cap is the feature: a result list).

    `project` (DataFrame -> DataFrame, keeping date and game_id) is applied
    before the sort and limit; projecting nested fields after a sort+limit
    trips a nested-pruning bug in Spark 4.1's TakeOrderedAndProject.
    """
    cond = match_teams(home, away)
    if season is not None:
        start, end = season_window(season)
    if start is not None:
        cond = cond & (F.col("date") >= _ts(start))
    if end is not None:
        cond = cond & (F.col("date") < _ts(end))
    found = games.where(cond)
    if project is not None:
        found = project(found)
    return found.orderBy("date", "game_id").limit(limit)


def season_of(date: str | Column = "date") -> Column:
    """Start year of the season a date falls in, NULL outside [1 Oct, 30 Apr)."""
    d = F.col(date) if isinstance(date, str) else date
    m, day, y = F.month(d), F.dayofmonth(d), F.year(d)
    in_fall = m >= SEASON_START_MONTH
    in_spring = (m < SEASON_END_MONTH) | ((m == SEASON_END_MONTH) & (day < SEASON_END_DAY))
    return F.when(in_fall, y).when(in_spring, y - 1).cast("int")


def season_games(games: DataFrame, seasons: DataFrame | None = None) -> DataFrame:
    """Games per season: of every season that occurs in the games, or of those
    in `seasons` (such as `seasons_dim`, the list of the select box).

    The range condition [1 Oct Y1, 30 Apr Y2) is turned into an equi-key (the
    season's start year) computed per game, so the games are aggregated before
    the season table is joined; no range join.
    """
    per = (games.select(season_of("date").alias("season"), "date")
           .where(F.col("season").isNotNull())
           .groupBy("season").agg(F.count(F.lit(1)).alias("games"),
                                 F.min("date").alias("first_date"), F.max("date").alias("last_date")))
    if seasons is None:
        return per.select("season", season_label("season").alias("label"), season_value("season").alias("value"),
                          "games", "first_date", "last_date")
    return seasons.select("season", "label", "value").join(per, "season")


def search_games_batch(games: DataFrame, searches: DataFrame, keys: list[str] | None = None,
                       limit: int = 20, columns: list[str] | None = None) -> DataFrame:
    """E7 for a table of searches `(keys..., home, away, start, end)`: the first
    `limit` games by date of each search, with their rank (`columns` of `game_summary`, or all).

    A pairing's games and the searches' starts share one index (`as_of_series`): a
    search's games are the places from its start on, so it meets the `limit` games it
    may list and never all games of its window.
    """
    from .asof import as_of_series
    from .rows import game_summary

    keys = keys or ["search_id"]
    g = game_summary(games)
    g = g.select(*columns) if columns is not None else g
    points = game_summary(games).select(F.col("home_abbr").alias("home"), F.col("away_abbr").alias("away"), "date", "game_id",
                                        F.struct(*g.columns).alias("g"))
    given = F.col("start").isNotNull() & (F.col("end") > F.col("start"))     # others find nothing
    wanted = searches.where(given).select("home", "away", "start", F.struct(*searches.columns).alias("s"))
    both = as_of_series(points, wanted, ["home", "away"], ["date", "game_id"], at="start")
    places = both.requests("first").select("home", "away", "s", F.explode(
        F.expr(f"sequence(first, first + {limit - 1})")).alias("idx"))
    found = (places.join(both.points().select("home", "away", "idx", "date", "g"), ["home", "away", "idx"])
             .where(F.col("date") < F.col("s.end")).select("s.*", "g.*"))
    w = Window.partitionBy(*keys).orderBy("date", "game_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)
            .drop("start", "end"))
