"""Per-request histories.

Requests are tables: `requests(request_id, rdate, home_abbr, away_abbr)` and
`roster(request_id, side, player)`. A player's history does not depend on the
request except through the context filters, so every context is an equi-join
on the columns the filter pins down (player, opponent, year, month); no join
emits all (request, history row) pairs of a player.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .asof import AsOfSeries, as_of_series
from .rows import PLAYER_ORDER

RECENT_BASE = 23      # fixed value: recent games taken = 30 - (7 - day) = 23 + day
RECENT_DAY_LIMIT = 7  # fixed value: recent games only when day of month < 7
RECENT_MAX = RECENT_BASE + RECENT_DAY_LIMIT - 1   # 29, the largest rank ever kept
BLOCK_PLACES = 32     # places of a player's series in one row, at least RECENT_MAX, so that recent games lie in two blocks

SEG_SAME_MONTH, SEG_OPPONENT, SEG_MONTH_TO_DATE, SEG_RECENT = 0, 1, 2, 3

POINT_COLS = ["game_id", "date", "bpos", "ppos", "pts"]


def _pcols(df: DataFrame) -> list[str]:
    """Point columns, plus the player's own series index `pidx` when present."""
    return POINT_COLS + (["pidx"] if "pidx" in df.columns else [])


def request_players(requests: DataFrame, roster: DataFrame) -> DataFrame:
    """(request_id, side, player) with the request's date parts and opponent.

    opp is the team the player's side faces: the away team for a home-side
    player and the home team for an away-side one.
    """
    r = roster.join(requests, "request_id")
    cols = [
        "request_id", "side", "player", "rdate",
        F.year("rdate").alias("ry"), F.month("rdate").alias("rm"), F.dayofmonth("rdate").alias("rd"),
        F.when(F.col("side") == "home", F.col("away_abbr")).otherwise(F.col("home_abbr")).alias("opp"),
    ]
    return r.select(*cols)


def request_players_of_games(rows: DataFrame) -> DataFrame:
    """`request_players` where every game is a request for itself, from its player rows in one scan."""
    opp = F.when(F.col("side") == "home", F.col("away_abbr")).otherwise(F.col("home_abbr"))
    rp = rows.select(F.col("game_id").alias("request_id"), "side", "player", F.col("date").alias("rdate"), opp.alias("opp")).distinct()
    return rp.select("request_id", "side", "player", "rdate", F.year("rdate").alias("ry"), F.month("rdate").alias("rm"),
                     F.dayofmonth("rdate").alias("rd"), "opp")


def _points(rows: DataFrame) -> DataFrame:
    return rows.select("player", *_pcols(rows), "home_abbr", "away_abbr",
                       F.year("date").alias("y"), F.month("date").alias("m"),
                       F.dayofmonth("date").alias("d"))


def _out(df: DataFrame, seg: int | None = None) -> DataFrame:
    cols = ["request_id", "side", "player"]
    if seg is not None:
        cols.append(F.lit(seg).alias("seg"))
    return df.select(*cols, *_pcols(df))


def _as_of(df: DataFrame, as_of: bool) -> DataFrame:
    return df.where(F.col("date") < F.col("rdate")) if as_of else df


def player_history(rows: DataFrame, roster: DataFrame) -> DataFrame:
    """every history row of every rostered player, per request.

    Its size is (requests of a player) x (that player's history), so no
    pipeline builds it: histories that do not depend on the request are
    aggregated or fitted once per player and joined to the roster
    (`player_history_summary`, P1, P2); this is for inspecting a few requests.
    """
    return rows.join(roster.select("request_id", "side", "player").distinct(), "player")


def player_history_summary(rows: DataFrame, roster: DataFrame) -> DataFrame:
    """F1 aggregated: (request_id, side, player, games, pts_sum, first, last).

    Aggregated per player first (partial + final), then joined to the roster,
    so the per-request work is one row per rostered player.
    """
    per_player = rows.join(roster.select("player").distinct(), "player", "left_semi").groupBy("player").agg(
        F.count(F.lit(1)).alias("games"), F.sum("pts").cast("bigint").alias("pts_sum"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    return roster.select("request_id", "side", "player").distinct().join(per_player, "player")


def opponent_history(rows: DataFrame, rp: DataFrame, as_of: bool = False) -> DataFrame:
    """Games of the player in which the requested opponent played on the
    other side (a home-side player: games whose away team is the requested away
    team; an away-side player: games whose home team is the requested home team).
    """
    keyed = _points(rows).select("*", F.explode(F.array(
        F.struct(F.lit("home").alias("rside"), F.col("away_abbr").alias("key")),
        F.struct(F.lit("away").alias("rside"), F.col("home_abbr").alias("key")))).alias("k"))
    keyed = keyed.select("*", F.col("k.rside").alias("side"), F.col("k.key").alias("opp")).drop("k")
    j = rp.select("request_id", "side", "player", "opp", "rdate").join(keyed, ["player", "side", "opp"])
    return _as_of(j, as_of)


def _dated_join(rp: DataFrame, rows: DataFrame, cond) -> DataFrame:
    r, p = rp.alias("r"), _points(rows).alias("p")
    j = r.join(p, (F.col("r.player") == F.col("p.player")) & cond)
    return j.select("r.request_id", "r.side", "r.player", "r.rdate", *[f"p.{c}" for c in _pcols(rows)])


def month_to_date(rows: DataFrame, rp: DataFrame, as_of: bool = False) -> DataFrame:
    """E5: games in the request's year and month, before the request's day."""
    r, p = lambda c: F.col(f"r.{c}"), lambda c: F.col(f"p.{c}")
    j = _dated_join(rp, rows, (r("ry") == p("y")) & (r("rm") == p("m")) & (p("d") < r("rd")))
    return _as_of(j, as_of)


def same_month_history(rows: DataFrame, rp: DataFrame, as_of: bool = False) -> DataFrame:
    """Games in the request's month of earlier years, up to the request's day."""
    r, p = lambda c: F.col(f"r.{c}"), lambda c: F.col(f"p.{c}")
    j = _dated_join(rp, rows, (r("rm") == p("m")) & (p("y") < r("ry")) & (p("d") <= r("rd")))
    return _as_of(j, as_of)


def newest_games(rows: DataFrame, k: int = RECENT_MAX) -> DataFrame:
    """The k newest games of every player with their rank (1 = newest).

    The constant bound lets Spark cut each player's rows to k per task before
    the shuffle (partial window group limit), so a long history never moves.
    """
    w = Window.partitionBy("player").orderBy(*[F.desc(c) for c in ("date", "game_id", "bpos", "ppos")])
    return (rows.select("player", *_pcols(rows)).withColumn("rk", F.row_number().over(w))
            .where(F.col("rk") <= k))


def recent_games(rows: DataFrame, rp: DataFrame, as_of: bool = False) -> DataFrame:
    """H3: when the request's day of month is below 7, the newest 23 + day games
    of the player over all dates (later ones too), with their rank. With
    `as_of`, the newest 23 + day games before the request's date."""
    early = rp.where(F.col("rd") < RECENT_DAY_LIMIT)
    if as_of:
        return _recent_before(rows, early)
    return early.join(newest_games(rows), "player").where(F.col("rk") <= F.lit(RECENT_BASE) + F.col("rd"))


def games_before(rows: DataFrame, rp: DataFrame) -> DataFrame:
    """(request_id, side, player, before): the player's games before the request's date."""
    return player_as_of(rows, rp).requests().select("request_id", "side", "player", "before")


def player_as_of(rows: DataFrame, rp: DataFrame, values: list[str] | None = None) -> AsOfSeries:
    """Player rows and request players in one index: each point's game number, each request's games before its date.
    The points keep their columns `values` (all)."""
    points = rows.select("player", *POINT_COLS, *[c for c in ("home_abbr", "away_abbr") if c in rows.columns])
    return as_of_series(points, rp, ["player"], PLAYER_ORDER, values=values)


def recent_blocks(rp: DataFrame) -> DataFrame:
    """The blocks of `BLOCK_PLACES` places that hold the last places before each early request: at most two a request.

    `rp` has `before`; adds `low`, the oldest place taken, and `block`.
    """
    low = F.greatest(F.col("before") - F.lit(RECENT_BASE) - F.col("rd"), F.lit(0))
    block = lambda place: F.floor(place / F.lit(BLOCK_PLACES))
    return (rp.where((F.col("rd") < RECENT_DAY_LIMIT) & (F.col("before") > 0)).withColumn("low", low)
            .select("*", F.explode(F.sequence(block(F.col("low")), block(F.col("before") - 1))).alias("block")))


def _recent_before(rows: DataFrame, early: DataFrame) -> DataFrame:
    """The newest games before each request, with their rank (1 = newest): the last places before its cut, found by
    (player, block of places) and unnested only after that, so that a request moves as two rows and not as its games."""
    series = player_as_of(rows, early)
    blocks = (series.points().withColumn("block", F.floor(F.col("idx") / F.lit(BLOCK_PLACES))).groupBy("player", "block")
              .agg(F.array_sort(F.collect_list(F.struct("idx", *POINT_COLS))).alias("places")))
    wanted = F.filter("places", lambda p: (p["idx"] >= F.col("low")) & (p["idx"] < F.col("before")))
    found = recent_blocks(series.requests()).join(blocks, ["player", "block"]).withColumn("p", F.explode(wanted))
    return (found.select("*", (F.col("before") - F.col("p.idx")).cast("int").alias("rk"), *[f"p.{c}" for c in POINT_COLS])
            .drop("before", "low", "block", "places", "p"))


def contextual_history(rows: DataFrame, rp: DataFrame, as_of: bool = False) -> DataFrame:
    """Same-month history (seg 0), versus opponent (1), month to date (2)
    and recent games (3), concatenated; a game in two segments counts twice.
    (`context.context_points` also numbers them, without sorting them.)

    Segments 0-2 come from ONE equi-join: every point is keyed once per
    context it can serve (its month; its home and away team; its year and
    month), every request player once per segment, and the join runs on
    (player, seg, key); only the day/year comparisons remain as a filter.
    Segment 3 joins the per-player top-29 (see `recent_games`).
    """
    def key(seg, kside, kint, kstr):
        return F.struct(F.lit(seg).alias("seg"), kside.alias("kside"),
                        kint.cast("bigint").alias("kint"), kstr.alias("kstr"))

    star, zero, blank = F.lit("*"), F.lit(0), F.lit("")
    p = _points(rows)
    pk = p.select("*", F.explode(F.array(
        key(SEG_SAME_MONTH, star, F.col("m"), blank),
        key(SEG_OPPONENT, F.lit("home"), zero, F.col("away_abbr")),
        key(SEG_OPPONENT, F.lit("away"), zero, F.col("home_abbr")),
        key(SEG_MONTH_TO_DATE, star, F.col("y") * 100 + F.col("m"), blank))).alias("k"))
    pk = pk.select("player", *_pcols(rows), "y", "d", "k.*")
    rk = rp.select("request_id", "side", "player", "rdate", "ry", "rd", F.explode(F.array(
        key(SEG_SAME_MONTH, star, F.col("rm"), blank),
        key(SEG_OPPONENT, F.col("side"), zero, F.col("opp")),
        key(SEG_MONTH_TO_DATE, star, F.col("ry") * 100 + F.col("rm"), blank))).alias("k"))
    rk = rk.select("request_id", "side", "player", "rdate", "ry", "rd", "k.*")
    j = rk.join(pk, ["player", "seg", "kside", "kint", "kstr"])
    seg = F.col("seg")
    keep = (F.when(seg == SEG_SAME_MONTH, (F.col("y") < F.col("ry")) & (F.col("d") <= F.col("rd")))
            .when(seg == SEG_MONTH_TO_DATE, F.col("d") < F.col("rd"))
            .otherwise(F.lit(True)))
    first = _as_of(j.where(keep), as_of).select("request_id", "side", "player", "seg", *_pcols(rows))
    return first.unionByName(_out(recent_games(rows, rp, as_of), SEG_RECENT))
