"""Unnesting games into player and team rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import LINE_FIELDS

PLAYER_ORDER = ["date", "game_id", "bpos", "ppos"]
TEAM_ORDER = ["date", "game_id", "tpos"]


def _team_abbr(home: bool) -> Column:
    """Abbreviation of the team flagged home (or not) in `teams`; position-free."""
    pick = F.filter("teams", (lambda t: t["home"]) if home else (lambda t: ~t["home"]))
    return F.get(pick, 0)["abbreviation"]


def has_player(names: Iterable[str]) -> Column:
    """A2: the game has some player line with one of `names` (before unnesting)."""
    names = list(names)
    return F.exists("box", lambda b: F.exists(
        F.coalesce(b["players"], F.array()), lambda p: p["player"].isin(names)))


def has_team(abbrs: Iterable[str]) -> Column:
    """A3: the game has a team with one of `abbrs` (before unnesting)."""
    abbrs = list(abbrs)
    return F.exists("teams", lambda t: t["abbreviation"].isin(abbrs))


def player_rows(games: DataFrame, players: Iterable[str] | None = None,
                stats: bool = False) -> DataFrame:
    """One row per player line.

    Columns: game_id, date, bpos (box position), ppos (line position in the
    box), side ('home'/'away' from teams[bpos].home), home, team, opponent,
    home_abbr, away_abbr, won, player, pts (+ all line fields with stats=True).
    Empty or missing boxes give no rows. With `players`, games are filtered
    before each unnest (A2, D3) as well as after it (E1).
    """
    names = list(players) if players is not None else None
    g = games
    if names is not None:
        g = g.where(has_player(names))
    g = g.select("game_id", "date", "teams",
                 _team_abbr(True).alias("home_abbr"), _team_abbr(False).alias("away_abbr"),
                 F.posexplode("box").alias("bpos", "b"))
    if names is not None:
        g = g.where(F.exists(F.coalesce(F.col("b.players"), F.array()),
                             lambda p: p["player"].isin(names)))
    team = F.get(F.col("teams"), F.col("bpos"))
    other = F.get(F.col("teams"), 1 - F.col("bpos"))
    # Game-level fields are projected before the second explode, so generated
    # player rows carry only flat columns (not the box or the teams array).
    g = g.select("game_id", "date", "bpos", "home_abbr", "away_abbr",
                 team["home"].alias("home"), team["abbreviation"].alias("team"),
                 other["abbreviation"].alias("opponent"), F.col("b.won").alias("won"),
                 F.col("b.players").alias("players"))
    g = g.select("game_id", "date", "bpos", "home_abbr", "away_abbr", "home", "team", "opponent", "won",
                 F.posexplode("players").alias("ppos", "p"))
    if names is not None:
        g = g.where(F.col("p.player").isin(names))
    extra = [F.col(f"p.{f.name}").alias(f.name) for f in LINE_FIELDS if f.name != "pts"] if stats else []
    return g.select(
        "game_id", "date", "bpos", "ppos",
        F.when(F.col("home"), "home").otherwise("away").alias("side"),
        "home", "team", "opponent", "home_abbr", "away_abbr", "won",
        F.col("p.player").alias("player"), F.col("p.pts").alias("pts"), *extra)


def team_rows(games: DataFrame, abbrs: Iterable[str] | None = None) -> DataFrame:
    """One row per team of a game (a team playing itself gives two rows).

    Columns: game_id, date, tpos, side, home, abbreviation, name, score, won, opponent.
    """
    g = games
    if abbrs is not None:
        abbrs = list(abbrs)
        g = g.where(has_team(abbrs))
    g = g.select("game_id", "date", "teams", F.posexplode("teams").alias("tpos", "t"))
    if abbrs is not None:
        g = g.where(F.col("t.abbreviation").isin(abbrs))
    other = F.get(F.col("teams"), 1 - F.col("tpos"))
    return g.select(
        "game_id", "date", "tpos",
        F.when(F.col("t.home"), "home").otherwise("away").alias("side"),
        F.col("t.home").alias("home"), F.col("t.abbreviation").alias("abbreviation"),
        F.col("t.name").alias("name"), F.col("t.score").alias("score"),
        F.col("t.won").alias("won"), other["abbreviation"].alias("opponent"))


def game_summary(games: DataFrame, *more: Column) -> DataFrame:
    """Flat per-game view: home/away abbreviations, scores, wins and roster sizes (and `more` columns)."""
    home_pos = F.when(F.get(F.col("teams"), 0)["home"], 0).otherwise(1)
    ht = F.get(F.col("teams"), home_pos)
    at = F.get(F.col("teams"), 1 - home_pos)
    hb = F.get(F.col("box"), home_pos)
    ab = F.get(F.col("box"), 1 - home_pos)
    return games.select(
        "game_id", "date", home_pos.alias("home_pos"),
        ht["abbreviation"].alias("home_abbr"), at["abbreviation"].alias("away_abbr"),
        ht["score"].alias("home_score"), at["score"].alias("away_score"),
        ht["won"].alias("home_won"), at["won"].alias("away_won"),
        F.size(F.coalesce(hb["players"], F.array())).alias("home_lines"),
        F.size(F.coalesce(ab["players"], F.array())).alias("away_lines"), *more)


def scores_from_games(games: DataFrame) -> DataFrame:
    """(request_id, side, abbreviation, score): what each team really scored."""
    return team_rows(games).select(F.col("game_id").alias("request_id"), "side", "abbreviation", "score")


def rosters_from_games(games: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every game as a prediction request.

    Returns (requests, roster, actual):
      requests (request_id, rdate, home_abbr, away_abbr)
      roster   (request_id, side, player)          distinct players per side
      actual   (request_id, side, player, pts)     points scored in that game
    """
    s = game_summary(games)
    requests = s.select(F.col("game_id").alias("request_id"), F.col("date").alias("rdate"),
                        "home_abbr", "away_abbr")
    rows = player_rows(games)
    actual = (rows.groupBy(F.col("game_id").alias("request_id"), "side", "player")
              .agg(F.sum("pts").cast("bigint").alias("pts")))
    roster = actual.select("request_id", "side", "player")
    return requests, roster, actual
