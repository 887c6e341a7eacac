"""P1-P4 and the report operators.

P1, P2 and P4 histories do not depend on the request, so the model is fitted
once per distinct player (or team) and joined to the requests; P3 fits per
(request_id, side, player) because its history is request-specific.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import round_half_up
from ..operators.asof import AsOfSeries, as_of_series, fit_best_as_of, fit_best_as_of_short, fit_split_as_of
from ..operators.context import by_length, context_pieces, context_points, context_sums, whole_histories, whole_sums
from ..operators.fit import CHUNK, fit_best_of, fit_split, pieces_in_runs
from ..operators.history import POINT_COLS, player_as_of, request_players
from ..operators.rows import PLAYER_ORDER, TEAM_ORDER, game_summary, player_rows, team_rows
from ..operators.search import season_of
from ..operators.sequence import with_sequence_index
from ..session import materialize

PLAYER_KEYS = ["request_id", "side", "player"]
LONGEST = CHUNK      # points and requests of a player that a task fits in one go
PRED_COLS = ["n", "n_fit", "rep", "slope", "intercept", "rmse", "r2", "prediction"]


def _played(games: DataFrame, players: DataFrame | None) -> DataFrame:
    rows = player_rows(games).where(F.col("pts").isNotNull())
    if players is not None:
        rows = rows.join(players.select("player").distinct(), "player", "left_semi")
    return rows


def player_series(games: DataFrame, players: DataFrame | None = None, keep: list[str] | None = None) -> DataFrame:
    """Each player's points in game order with idx = 0, 1, 2, ...

    Lines without points (the player did not play) are no points of the series.
    With `players` (a column `player`), only those players' rows are kept
    before indexing (left-semi join; Spark picks broadcast at runtime when the
    list is small). With `keep`, the series has only these columns, the player
    and idx.
    """
    return with_sequence_index(_played(games, players), ["player"], PLAYER_ORDER, keep=keep)


def team_series(games: DataFrame, abbrs: DataFrame | None = None) -> DataFrame:
    """H2: each team's scores in game order with idx."""
    rows = team_rows(games).where(F.col("score").isNotNull())
    if abbrs is not None:
        rows = rows.join(abbrs.select("abbreviation").distinct(), "abbreviation", "left_semi")
    return with_sequence_index(rows, ["abbreviation"], TEAM_ORDER)


def quick_models(games: DataFrame, players: DataFrame | None = None, reg: float = 0.001,
                 frac: float = 0.7) -> DataFrame:
    """P1's model of every player (of `players`): they do not depend on a request."""
    return fit_split(player_series(games, players, ["pts"]), ["player"], frac=frac, reg=reg)


def best_models(games: DataFrame, players: DataFrame | None = None, reps: int = 100, frac: float = 0.7) -> DataFrame:
    """P2's model of every player (of `players`)."""
    return fit_best_of(player_series(games, players, ["pts"]), ["player"], reps=reps, frac=frac, dense_index=True)


def attach_models(models: DataFrame, roster: DataFrame) -> DataFrame:
    """Forecasts of rostered players from their models."""
    m = models if "rep" in models.columns else models.withColumn("rep", F.lit(0))
    return roster.select(*PLAYER_KEYS).join(m, "player").select(*PLAYER_KEYS, *PRED_COLS)


def _cuts(games: DataFrame, roster: DataFrame, rp: DataFrame) -> AsOfSeries:
    """One index over the points of the rostered players and their requests."""
    return player_as_of(_played(games, roster), rp)


def _fit_cuts(games: DataFrame, roster: DataFrame, rp: DataFrame) -> AsOfSeries:
    """`_cuts` with what a fit reads of points and requests."""
    return player_as_of(_played(games, roster).select("player", *POINT_COLS), rp.select(*PLAYER_KEYS, "rdate"), ["pts"])


def predict_players(games: DataFrame, roster: DataFrame, reg: float = 0.001, frac: float = 0.7,
                    requests: DataFrame | None = None, as_of: bool = False, rp: DataFrame | None = None) -> DataFrame:
    """P1 (quick): one `frac` sample per player, L2 penalty `reg`, forecast next game.

    With `as_of`, the model of a request (`requests` gives its date, or `rp`, the
    request players, all of it) is fitted on the games before that date only;
    players without one vanish.
    """
    if not as_of:
        return attach_models(quick_models(games, roster, reg, frac), roster)
    s = _fit_cuts(games, roster, request_players(requests, roster) if rp is None else rp)
    models = fit_split_as_of(s.points(), ["player"], s.requests(), frac=frac, reg=reg, stream=s.stream())
    return models.withColumn("rep", F.lit(0)).select(*PLAYER_KEYS, *PRED_COLS)


def predict_players_best(games: DataFrame, roster: DataFrame, reps: int = 100, frac: float = 0.7,
                         requests: DataFrame | None = None, as_of: bool = False, rp: DataFrame | None = None) -> DataFrame:
    """Best of the full fit and reps-1 samples per player; `as_of` as in P1, with the samples of the games before."""
    if not as_of:
        return attach_models(best_models(games, roster, reps, frac), roster)
    rp = materialize((request_players(requests, roster) if rp is None else rp).select(*PLAYER_KEYS, "rdate"), "requests")
    rows = lambda df, points: df.select("player", F.lit(points).alias("points"), F.lit(1 - points).alias("cuts"))
    each = materialize(rows(_played(games, None), 1).union(rows(rp, 0)).groupBy("player").agg(
        F.sum("points").alias("points"), F.sum("cuts").alias("cuts")).where("player IS NOT NULL"), "series-lengths")
    asked = F.col("cuts") > 0
    long = asked & (F.col("points") + F.col("cuts") > LONGEST)
    total = each.agg(F.sum("points").alias("points"), F.sum(F.when(asked & ~long, F.col("points"))).alias("asked"),
                     F.count(F.when(long, 1)).alias("long")).first()
    # the rows of players without a request (or with a long series) are left out first where they are many
    few = 2 * (total["asked"] or 0) < (total["points"] or 0)
    points, cuts = _played(games, each.where(asked & ~long) if few else None), rp
    if total["long"]:
        others = each.where(long)
        points, cuts = (df.join(others.select("player"), "player", "left_anti") for df in (points, cuts))
    models = fit_best_as_of_short(points, ["player"], cuts, PLAYER_ORDER, reps=reps, frac=frac).select(*PLAYER_KEYS, *PRED_COLS)
    if total["long"]:
        s = _fit_cuts(games, others, rp.join(others.select("player"), "player", "left_semi"))
        models = models.unionByName(fit_best_as_of(s.points(), ["player"], s.requests(), reps=reps, frac=frac,
                                                   stream=s.stream()).select(*PLAYER_KEYS, *PRED_COLS))
    return models


CONTEXT_COLS = ["date", "game_id", "pts", "home_abbr", "away_abbr"]


def context_series(games: DataFrame, requests: DataFrame | None, roster: DataFrame, as_of: bool = False,
                   rp: DataFrame | None = None, pieces: bool = False, sums: bool = False) -> DataFrame:
    """J1 indexed per (request_id, side, player): segment by segment, points in the player's own game order (newest
    first for recent games). The numbers come from ranks (`operators.context`); context points are neither sorted nor
    written. With `pieces`, as `context.context_pieces`; with `sums`, as `context.context_sums`."""
    history = context_sums if sums else context_pieces if pieces else context_points
    rp = request_players(requests, roster) if rp is None else rp
    if as_of:
        s = _cuts(games, roster, rp)
        return history(s.points(), s.requests(), as_of=True)
    if sums:
        one, others = by_length(player_series(games, roster, CONTEXT_COLS), rp)
        return whole_sums(*one) if others is None else whole_sums(*one).unionByName(context_sums(*others))
    return history(player_series(games, roster, CONTEXT_COLS), rp)


def predict_players_context(games: DataFrame, requests: DataFrame | None, roster: DataFrame, reps: int = 100,
                            frac: float = 0.7, as_of: bool = False, rp: DataFrame | None = None) -> DataFrame:
    """Contextual history per request, best of reps fits, forecast."""
    rp = request_players(requests, roster) if rp is None else rp
    if as_of:
        series = pieces_in_runs(context_series(games, requests, roster, as_of, rp, pieces=True), PLAYER_KEYS)
    else:
        one, others = by_length(player_series(games, roster, CONTEXT_COLS), rp)
        series = pieces_in_runs(whole_histories(*one), PLAYER_KEYS, single=True)
        if others is not None:
            series = series.unionByName(pieces_in_runs(context_pieces(*others), PLAYER_KEYS))
    return fit_best_of(series, PLAYER_KEYS, reps=reps, frac=frac, dense_index=True, in_runs=True).select(*PLAYER_KEYS, *PRED_COLS)


def request_sides(requests: DataFrame, *more: str) -> DataFrame:
    """(request_id, side, abbreviation, more columns of the request): the two teams of each request."""
    s = requests.select("request_id", *more, F.explode(F.array(
        F.struct(F.lit("home").alias("side"), F.col("home_abbr").alias("abbreviation")),
        F.struct(F.lit("away").alias("side"), F.col("away_abbr").alias("abbreviation")))).alias("s"))
    return s.select("request_id", *more, "s.side", "s.abbreviation")


def predict_teams(games: DataFrame, requests: DataFrame, reps: int = 100, frac: float = 0.7,
                  as_of: bool = False) -> DataFrame:
    """Best-of fit of each requested team's scores, forecast next game.

    With `as_of`, on the team's games before the request's date only; teams without one vanish.
    """
    cols = ["request_id", "side", "abbreviation", *PRED_COLS]
    if as_of:
        wanted = request_sides(requests, "rdate")
        scores = team_rows(games).where(F.col("score").isNotNull()).select(
            "abbreviation", *TEAM_ORDER, F.col("score").alias("pts"))
        s = as_of_series(scores, wanted, ["abbreviation"], TEAM_ORDER)
        return fit_best_as_of(s.points(), ["abbreviation"], s.requests(), reps=reps, frac=frac, stream=s.stream()).select(*cols)
    sides = request_sides(requests)
    series = team_series(games, sides).withColumnRenamed("score", "pts")
    models = fit_best_of(series, ["abbreviation"], reps=reps, frac=frac, dense_index=True)
    return sides.join(models, "abbreviation").select(*cols)


def top_per_side(preds: DataFrame, k: int = 20, by: str = "player") -> DataFrame:
    """At most k rows per (request_id, side), by name (the output cap of the
    prediction file is the feature)."""
    w = Window.partitionBy("request_id", "side").orderBy(by)
    return preds.withColumn("line", F.row_number().over(w)).where(F.col("line") <= k)


def team_totals(preds: DataFrame) -> DataFrame:
    """Predicted team score = sum of the rounded player forecasts."""
    return preds.groupBy("request_id", "side").agg(
        F.sum(round_half_up("prediction")).cast("bigint").alias("total"),
        F.count(F.lit(1)).alias("players"))


def actual_vs_predicted(actual: DataFrame, preds: DataFrame) -> DataFrame:
    """actual points of the request's game next to the forecast (left join:
    players without history have no forecast)."""
    p = preds.select(*PLAYER_KEYS, "prediction", round_half_up("prediction").alias("predicted"))
    return actual.select(*PLAYER_KEYS, F.col("pts").alias("actual")).join(p, PLAYER_KEYS, "left")


def score_vs_predicted(scores: DataFrame, preds: DataFrame) -> DataFrame:
    """each side's real score next to its predicted total (none without forecasts)."""
    return scores.join(team_totals(preds), ["request_id", "side"], "left")


def comparison_lists(compared: DataFrame) -> DataFrame:
    """I4: `actual_vs_predicted` as shown: one list per request and side, by player.

    One group per request side, bounded by its roster.
    """
    line = F.struct("player", "actual", "predicted")
    return compared.groupBy("request_id", "side").agg(F.array_sort(F.collect_list(line)).alias("players"))


def comparison_text(compared: DataFrame) -> DataFrame:
    """The comparison to show, a text per request and side: `player actual predicted` lines in the order of
    `comparison_lists`; a player without a forecast has `-`."""
    shown = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    lines = F.transform("players", lambda p: F.concat_ws(" ", p["player"], shown(p["actual"]), shown(p["predicted"])))
    return comparison_lists(compared).select("request_id", "side", F.array_join(lines, "\n").alias("lines"))


def listed_games(games: DataFrame, teams: DataFrame, seasons: DataFrame) -> DataFrame:
    """Every game with its teams' names and its season's label, null where `teams` (abbr, name) and `seasons`
    (season, label) don't list them, and whether all three are listed."""
    s = game_summary(games).select("game_id", "home_abbr", "away_abbr", season_of("date").alias("season"))
    named = lambda side: teams.select(F.col("abbr").alias(f"{side}_abbr"), F.col("name").alias(f"{side}_name"))
    j = (s.join(named("home"), "home_abbr", "left").join(named("away"), "away_abbr", "left")
         .join(seasons.select("season", "label"), "season", "left"))
    listed = F.col("home_name").isNotNull() & F.col("away_name").isNotNull() & F.col("label").isNotNull()
    return j.select("game_id", "season", "label", "home_abbr", "home_name", "away_abbr", "away_name", listed.alias("listed"))


def validate_requests(requests: DataFrame, teams: DataFrame) -> DataFrame:
    """Known-team flags per request, by exact membership in `teams(abbr)`.

    No broadcast hint: the dimension is the caller's table. AQE broadcasts it
    at runtime when its measured size is small (30 teams)."""
    dim = teams.select(F.col("abbr")).distinct()
    h = dim.select(F.col("abbr").alias("home_abbr"), F.lit(True).alias("home_ok"))
    a = dim.select(F.col("abbr").alias("away_abbr"), F.lit(True).alias("away_ok"))
    r = requests.join(h, "home_abbr", "left").join(a, "away_abbr", "left")
    return r.select("request_id", "home_abbr", "away_abbr",
                    F.coalesce("home_ok", F.lit(False)).alias("home_ok"),
                    F.coalesce("away_ok", F.lit(False)).alias("away_ok"),
                    (F.coalesce("home_ok", F.lit(False)) & F.coalesce("away_ok", F.lit(False))).alias("valid"))
