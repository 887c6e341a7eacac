import datetime as dt

from pyspark.sql import functions as F

from gamecast.operators import history as H
from gamecast.operators import rows as R
from gamecast.plans import pipelines as PL


def _req(spark, rid, date, home, away, roster):
    requests = spark.createDataFrame([(rid, dt.datetime.fromisoformat(date), home, away)],
                                     "request_id bigint, rdate timestamp_ntz, home_abbr string, away_abbr string")
    ros = spark.createDataFrame([(rid, s, p) for s, p in roster], "request_id bigint, side string, player string")
    return requests, ros


def _games_of(df):
    return sorted(r.game_id for r in df.collect())


def test_month_to_date_is_strict_same_month_is_inclusive(spark, small_games):
    rows = R.player_rows(small_games)
    requests, roster = _req(spark, 1, "2013-01-07", "BOS", "NYK", [("home", "Ann")])
    rp = H.request_players(requests, roster)
    assert _games_of(H.month_to_date(rows, rp)) == [6]          # 3 Jan; 7 Jan itself excluded
    requests, roster = _req(spark, 1, "2014-01-05", "BOS", "NYK", [("home", "Ann")])
    rp = H.request_players(requests, roster)
    assert _games_of(H.same_month_history(rows, rp)) == [1, 2, 6]   # day <= 5 of January, earlier years


def test_opponent_history_by_side(spark, small_games):
    rows = R.player_rows(small_games)
    requests, roster = _req(spark, 1, "2013-03-01", "BOS", "NYK", [("home", "Ann"), ("away", "Cy")])
    rp = H.request_players(requests, roster)
    got = sorted((r.player, r.game_id) for r in H.opponent_history(rows, rp).collect())
    # home-side Ann: games whose away team is NYK; away-side Cy: games whose home team is BOS
    assert got == [("Ann", 1), ("Ann", 5), ("Ann", 6), ("Ann", 8), ("Cy", 1), ("Cy", 5), ("Cy", 6), ("Cy", 8)]


def test_recent_games_day_below_seven_only(spark, small_games):
    rows = R.player_rows(small_games)
    requests, roster = _req(spark, 1, "2013-01-06", "BOS", "NYK", [("home", "Ann")])
    got = H.recent_games(rows, H.request_players(requests, roster)).collect()
    assert len(got) == 9 and min(r.rk for r in got) == 1      # 23 + 6 = 29 > 9 games: all, later ones too
    requests, roster = _req(spark, 1, "2013-01-07", "BOS", "NYK", [("home", "Ann")])
    assert H.recent_games(rows, H.request_players(requests, roster)).count() == 0


def test_recent_games_cap(spark, make_games):
    from conftest import game
    gs = [game(i, dt.datetime(2010, 1, 1) + dt.timedelta(days=i), "BOS", "NYK", [("P", i)], [])
          for i in range(40)]
    rows = R.player_rows(make_games(gs))
    requests, roster = _req(spark, 1, "2012-05-02", "BOS", "NYK", [("home", "P")])
    got = H.recent_games(rows, H.request_players(requests, roster)).collect()
    assert len(got) == 25 and sorted(r.game_id for r in got) == list(range(15, 40))


def test_contextual_history_counts_twice_and_orders(spark, small_games):
    games = small_games
    requests, roster = _req(spark, 1, "2013-01-05", "BOS", "NYK", [("home", "Ann")])
    s = PL.context_series(games, requests, roster)
    segs = sorted((r.seg, r.game_id) for r in s.collect())
    # same month of earlier years up to day 5: g1, g2; vs NYK away: g1, g5, g6, g8;
    # month to date: g6; recent (day 5 < 7): all 9 of Ann's games
    assert [g for s_, g in segs if s_ == 0] == [1, 2]
    assert [g for s_, g in segs if s_ == 1] == [1, 5, 6, 8]
    assert [g for s_, g in segs if s_ == 2] == [6]
    assert len([g for s_, g in segs if s_ == 3]) == 9
    order = [r.game_id for r in s.orderBy("idx").collect()]
    assert order[:7] == [1, 2, 1, 5, 6, 8, 6]
    assert order[7:] == [9, 8, 7, 6, 5, 4, 3, 2, 1]            # recent games newest first


def test_player_without_history_vanishes(spark, small_games):
    _, roster = _req(spark, 1, "2013-03-01", "BOS", "NYK", [("home", "Ann"), ("home", "Nobody")])
    preds = PL.predict_players(small_games, roster)
    assert [r.player for r in preds.collect()] == ["Ann"]


def test_team_predictions_and_totals(spark, small_games):
    requests, roster = _req(spark, 1, "2013-03-01", "BOS", "NYK", [("home", "Ann"), ("home", "Flat"), ("away", "Cy")])
    tp = {r.side: r for r in PL.predict_teams(small_games, requests).collect()}
    assert tp["home"].abbreviation == "BOS" and tp["home"].n == 10   # BOS plays itself once: two rows
    preds = PL.predict_players(small_games, roster)
    tot = {r.side: r.total for r in PL.team_totals(preds).collect()}
    exp = {}
    for r in preds.collect():
        exp[r.side] = exp.get(r.side, 0) + int((r.prediction + 0.5) // 1)
    assert tot == exp


def test_validate_requests_exact_membership(spark):
    from gamecast.schema import teams_dim
    req = spark.createDataFrame([(1, "BOS", "NYK"), (2, "B", "NYK"), (3, "BOS", "Boston Celtics")],
                                "request_id bigint, home_abbr string, away_abbr string")
    got = {r.request_id: r.valid for r in PL.validate_requests(req, teams_dim(spark)).collect()}
    assert got == {1: True, 2: False, 3: False}


def test_top_per_side_caps_at_twenty(spark):
    preds = spark.range(50).select(F.lit(1).cast("bigint").alias("request_id"),
                                   F.when(F.col("id") < 30, "home").otherwise("away").alias("side"),
                                   F.format_string("p%02d", "id").alias("player"),
                                   F.col("id").cast("double").alias("prediction"))
    got = PL.top_per_side(preds).groupBy("side").count().collect()
    assert {r.side: r["count"] for r in got} == {"home": 20, "away": 20}


def test_as_of_cuts_history_at_request_date(spark, small_games):
    requests, roster = _req(spark, 1, "2013-01-05", "BOS", "NYK", [("home", "Ann")])
    plain = PL.context_series(small_games, requests, roster)
    cut = PL.context_series(small_games, requests, roster, as_of=True)
    assert plain.where("seg = 3").count() == 9                    # recent games include later ones
    got = sorted((r.seg, r.game_id) for r in cut.collect())
    assert all(g <= 6 for _, g in got)                             # games 7-9 are after 5 Jan 2013
    assert [g for s_, g in got if s_ == 1] == [1, 5, 6]
    assert sorted(r.idx for r in cut.collect()) == list(range(len(got)))


def test_recent_games_as_of_are_the_newest_before_the_request(spark, make_games):
    """51 games before the request and many after it: the last 26 before day 3 count."""
    from conftest import game
    gs = [game(k, str(dt.date(2012, 1, 1) + dt.timedelta(days=k)), "BOS", "NYK", [("Ann", k)], None) for k in range(200)]
    games = make_games(gs)
    requests, roster = _req(spark, 1, "2012-03-03", "BOS", "NYK", [("home", "Ann"), ("away", "Nobody")])
    rp = H.request_players(requests, roster)
    day = (dt.date(2012, 3, 3) - dt.date(2012, 1, 1)).days
    got = sorted(r.game_id for r in H.recent_games(R.player_rows(games), rp, as_of=True).collect())
    assert got == list(range(day - 26, day))
    seg = PL.context_series(games, requests, roster, as_of=True).where("seg = 3")
    assert sorted(r.game_id for r in seg.collect()) == got
    before = {r.player: r.before for r in H.games_before(R.player_rows(games), rp).collect()}
    assert before == {"Ann": day, "Nobody": 0}


def test_predict_as_of_fits_the_games_before(spark, make_games):
    from conftest import game
    gs = [game(k, str(dt.date(2012, 1, 1) + dt.timedelta(days=k)), "BOS", "NYK", [("Ann", 2 * k if k < 50 else 0)], None)
          for k in range(120)]
    requests, roster = _req(spark, 1, "2012-02-20", "BOS", "NYK", [("home", "Ann")])
    (r,) = PL.predict_players(make_games(gs), roster, reg=0.0, requests=requests, as_of=True).collect()
    assert (r.n, r.slope, r.intercept, r.prediction) == (50, 2.0, 0.0, 100.0)
    early, _ = _req(spark, 1, "2012-01-01", "BOS", "NYK", [("home", "Ann")])
    assert PL.predict_players(make_games(gs), roster, requests=early, as_of=True).count() == 0


def _numbered(rows, rp, as_of=False):
    """J1 as the four joins say it, numbered by sorting: {(request, side, player, seg, game): [numbers]}."""
    out = {}
    pidx = {}
    for r in sorted(rows.where("pts IS NOT NULL").collect(), key=lambda r: (r.player, r.date, r.game_id, r.bpos, r.ppos)):
        pidx[r.player, r.game_id, r.bpos, r.ppos] = sum(1 for k in pidx if k[0] == r.player)
    hist = {}
    for r in H.contextual_history(rows.where("pts IS NOT NULL"), rp, as_of).collect():
        place = pidx[r.player, r.game_id, r.bpos, r.ppos]
        hist.setdefault((r.request_id, r.side, r.player), []).append((r.seg, -place if r.seg == H.SEG_RECENT else place, r.game_id))
    for key, points in hist.items():
        for n, (seg, _, game) in enumerate(sorted(points)):
            out.setdefault((*key, seg, game), []).append(n)
    return out


def test_ranks_number_the_history_as_sorting_does(spark, make_games):
    """Many requests over a few seasons: leap days, days 1 to 31, teams meeting twice a month, players on both sides."""
    import random

    from conftest import game
    rng = random.Random(4)
    teams, players = ["BOS", "NYK", "MIA"], ["Ann", "Bo", "Cy", "Dee"]
    gs = []
    for k in range(150):
        home, away = rng.sample(teams, 2)
        picked = rng.sample(players, 3)
        day = dt.date(2010, 1, 1) + dt.timedelta(days=rng.choice([0, 365, 731, 1096]) + rng.randrange(70))
        gs.append(game(k, str(day), home, away, [(picked[0], rng.choice([None, 3, 5, 9]) or 1)], [(p, rng.randrange(30)) for p in picked[1:]],
                       home_first=k % 2 == 0))
    games = make_games(gs)
    rows = R.player_rows(games)
    rp = H.request_players_of_games(rows)
    for as_of in (False, True):
        got = {}
        for r in PL.context_series(games, None, rp, as_of=as_of, rp=rp).collect():
            got.setdefault((r.request_id, r.side, r.player, r.seg, r.game_id), []).append(r.idx)
        assert {k: sorted(v) for k, v in got.items()} == _numbered(rows, rp, as_of)


def test_best_forecasts_as_of_requests(spark, make_games):
    """P2 and P4 fit the games before a request only; teams and players without one vanish."""
    from conftest import game
    gs = [game(k, str(dt.date(2012, 1, 1) + dt.timedelta(days=k)), "BOS", "NYK", [("Ann", 2 * k if k < 50 else 0)], None)
          for k in range(120)]
    games = make_games(gs)
    requests, roster = _req(spark, 1, "2012-02-20", "BOS", "NYK", [("home", "Ann"), ("away", "Nobody")])
    (r,) = PL.predict_players_best(games, roster, requests=requests, as_of=True).collect()
    assert (r.n, r.rep, r.slope, r.intercept, r.prediction) == (50, 0, 2.0, 0.0, 100.0)
    teams = {t.abbreviation: t for t in PL.predict_teams(games, requests, as_of=True).collect()}
    assert (teams["BOS"].n, teams["BOS"].prediction, teams["NYK"].n, teams["NYK"].prediction) == (50, 100.0, 50, 0.0)
    early, _ = _req(spark, 1, "2012-01-01", "BOS", "NYK", [("home", "Ann")])
    assert PL.predict_teams(games, early, as_of=True).count() == 0
    assert PL.predict_players_best(games, roster, requests=early, as_of=True).count() == 0


def test_as_of_plans_scan_the_written_series(spark, small_games):
    from test_plans import plan
    rows = R.player_rows(small_games)
    rp = H.request_players_of_games(rows)
    for p in (plan(PL.predict_players(small_games, rp, as_of=True, rp=rp)),
              plan(PL.predict_players_best(small_games, rp, as_of=True, rp=rp)),
              plan(H.recent_games(rows, rp, as_of=True))):
        assert p.count("\nLocation:") <= 2


def test_recent_games_of_a_request_move_as_two_rows(spark):
    """29 places at most lie in two blocks: a request is never as many rows as it has recent games."""
    cuts = [0, 1, 5, 26, 31, 32, 33, 63, 64, 200]
    rp = spark.createDataFrame([(c, "Ann", c, rd) for c in cuts for rd in (1, 6, 7)], "request_id bigint, player string, before bigint, rd int")
    got = {}
    for r in H.recent_blocks(rp).collect():
        got.setdefault((r.before, r.rd), []).append((r.low, r.block))
    assert sorted(got) == sorted((c, rd) for c in cuts if c for rd in (1, 6))
    for (before, rd), blocks in got.items():
        low = max(before - 23 - rd, 0)
        assert sorted(blocks) == [(low, b) for b in sorted({k // H.BLOCK_PLACES for k in range(low, before)})] and len(blocks) <= 2


def test_context_sums_are_those_of_the_points(spark, make_games):
    """Long lists (several pieces), several games a day, days 1 to 31: sums by running sums are those of every point."""
    import random

    from conftest import game
    rng = random.Random(9)
    teams, players = ["BOS", "NYK", "MIA"], ["Ann", "Bo", "Cy"]
    gs = []
    for k in range(300):
        home, away = rng.sample(teams, 2)
        picked = rng.sample(players, 2)
        day = dt.date(2010, 1, 1) + dt.timedelta(days=rng.choice([0, 365, 731]) + rng.randrange(45))
        gs.append(game(k, str(day), home, away, [(picked[0], rng.randrange(30))], [(picked[1], rng.randrange(30))]))
    games = make_games(gs)
    rp = H.request_players_of_games(R.player_rows(games))
    for as_of in (False, True):
        want = {}
        for r in PL.context_series(games, None, rp, as_of=as_of, rp=rp).collect():
            s = want.setdefault((r.request_id, r.side, r.player, r.seg), [0, 0, 0, 0])
            for i, v in enumerate((1, r.pts, r.idx, r.idx * r.pts)):
                s[i] += v
        sums = PL.context_series(games, None, rp, as_of=as_of, rp=rp, sums=True)
        got = {(r.request_id, r.side, r.player, r.seg): [r.n, r.pts_sum, r.idx_sum, r.idx_pts] for r in sums.collect()}
        assert got == want and any(n > 64 for n, *_ in want.values())


def test_fits_index_only_what_they_read(spark, small_games, tmp_path):
    """The index of a series writes the columns that go on, not those that only order it."""
    from gamecast.operators.sequence import with_sequence_index
    rows = R.player_rows(small_games)
    path = str(tmp_path / "indexed")
    whole = with_sequence_index(rows, ["player"], R.PLAYER_ORDER)
    narrow = with_sequence_index(rows, ["player"], R.PLAYER_ORDER, path=path, keep=["pts", "game_id"])
    assert set(spark.read.parquet(path).columns) == {"player", "pts", "game_id", "_part", "_at", "_upto"}
    assert sorted(narrow.collect()) == sorted(whole.select("player", "pts", "game_id", "idx").collect())
    assert whole.columns == [*rows.columns, "idx"]
    assert PL.player_series(small_games, keep=["pts"]).columns == ["player", "pts", "idx"]
    rp = H.request_players_of_games(rows)
    assert PL._fit_cuts(small_games, rp, rp).points().columns == ["player", "pts", "idx"]


def test_whole_histories_are_those_of_the_pieces(spark, make_games, monkeypatch):
    """Players whose lists are one row, longer ones, a game without a date, and a request key in two rows: sums and fits are those of the points."""
    import random

    from conftest import game

    from gamecast.operators import context as CX
    from gamecast.operators import fit as FT
    rng = random.Random(8)
    teams, players = ["BOS", "NYK", "MIA"], ["Ann", "Bo", "Cy", "Dee"]
    gs = []
    for k in range(120):
        home, away = rng.sample(teams, 2)
        day = dt.date(2010, 1, 1) + dt.timedelta(days=rng.choice([0, 365, 731, 1096]) + rng.randrange(70))
        picked = rng.sample(players, 2)
        gs.append(game(k, None if k == 7 else str(day), home, away, [(picked[0], rng.randrange(30))],
                       [(picked[1], rng.randrange(30))] + [("Eve", k)] * (k % 5 == 0)))
    games = make_games(gs)
    rp = H.request_players_of_games(R.player_rows(games)).where("request_id < 60")
    twice = rp.where("request_id = 30").withColumn("rd", F.col("rd") + F.lit(1)).withColumn("opp", F.lit("MIA"))
    rp = rp.unionByName(twice).unionByName(rp.limit(1).withColumn("player", F.lit(None).cast("string")))
    rp = spark.createDataFrame(rp.collect(), rp.schema)
    keys = CX.KEYS
    points = CX.context_points(PL.player_series(games, rp), rp)
    assert points.where("request_id = 7 and seg = 1").count() > 0       # a request without a date
    want = sorted(map(tuple, points.groupBy(*keys, "seg").agg(
        F.count("*").alias("n"), F.sum("pts"), F.sum("idx"), F.sum(F.col("idx") * F.col("pts"))).collect()))
    once = rp.groupBy(*keys).count().where("count = 1").select(*keys)
    fits = {tuple(r) for r in FT.fit_best_of(points.join(once, keys), keys, reps=8).select(*keys, *PL.PRED_COLS).collect()}
    for longest in (CX.LONGEST, 30, 0):
        monkeypatch.setattr(CX, "LONGEST", longest)
        sums = PL.context_series(games, None, rp, rp=rp, sums=True)
        assert sorted(map(tuple, sums.select(*keys, "seg", "n", "pts_sum", "idx_sum", "idx_pts").collect())) == want
        got = PL.predict_players_context(games, None, rp, reps=8, rp=rp).join(once, keys)
        assert {tuple(r) for r in got.select(*keys, *PL.PRED_COLS).collect()} == fits


def test_a_request_meets_its_history_in_one_join(spark, small_games):
    """P3's points and J1's sums are not shuffled: of what depends on a request only itself and its sums move."""
    rp = H.request_players_of_games(R.player_rows(small_games))
    moved = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression")
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    sums = PL.context_series(small_games, None, rp, rp=rp, sums=True)
    assert plan(sums).count("Join") <= 1 + plan(PL.player_series(small_games, rp)).count("Join") and moved(sums) <= 1
    fits = PL.predict_players_context(small_games, None, rp, rp=rp)
    assert moved(fits) == 2 and "_g, " not in fits._jdf.queryExecution().optimizedPlan().toString().split("MapInPandas")[0]


def test_short_series_are_fitted_as_of_cuts_in_one_move(spark, make_games, monkeypatch):
    """Points and requests of one moment, players without requests and without games, keys that repeat or are null, and a
    player whose series goes by the index: the fits are those of the index."""
    import random

    from conftest import game

    from gamecast.operators import asof as A
    rng = random.Random(12)
    gs = []
    for k in range(90):
        day = dt.date(2011, 1, 1) + dt.timedelta(days=rng.randrange(40))
        a, b = rng.sample(["Ann", "Bo", "Cy", "Dee"], 2)
        gs.append(game(k, str(day), "BOS", "NYK", [(a, rng.randrange(40)), ("Idle", 3)], [(b, rng.randrange(40))] + [("Eve", k)] * (k % 9 == 0)))
    games = make_games(gs)
    rp = H.request_players_of_games(R.player_rows(games)).where("player <> 'Idle' and request_id % 2 = 0")
    odd = rp.where("request_id = 8")
    rp = rp.unionByName(odd).unionByName(odd.withColumn("player", F.lit("Nobody"))).unionByName(odd.withColumn("player", F.lit(None).cast("string")))
    rp = rp.unionByName(odd.withColumn("request_id", F.lit(None).cast("bigint")))
    rp = spark.createDataFrame(rp.collect(), rp.schema)
    s = PL._fit_cuts(games, rp, rp)
    named = lambda df: sorted(map(str, df.select(*PL.PLAYER_KEYS, *PL.PRED_COLS).collect()))
    want = named(A.fit_best_as_of(s.points(), ["player"], s.requests(), reps=12, stream=s.stream()))
    assert len(want) > 60
    for longest in (PL.LONGEST, 25, 0):
        monkeypatch.setattr(PL, "LONGEST", longest)
        assert named(PL.predict_players_best(games, rp, reps=12, as_of=True, rp=rp)) == want
    monkeypatch.undo()
    plan = PL.predict_players_best(games, rp, reps=12, as_of=True, rp=rp)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") <= 2 and "Join" not in plan.split("MapInPandas")[0]


def test_short_series_of_fractional_and_missing_points(spark):
    from gamecast.operators import asof as A
    rows = [("a", k // 2, k, None if k % 7 == 3 else k * 1.5 + k % 3) for k in range(60)] + [("b", 5, 0, None), ("c", 1, 0, 2.0)]
    points = spark.createDataFrame(rows, "k string, t int, n int, pts double")
    wanted = spark.createDataFrame([(k, t, t) for k in "abcd" for t in (0, 1, 2, 9, 31)], "k string, rdate int, tag int")
    indexed = A.as_of_series(points, wanted, ["k"], ["t", "n"])
    want = A.fit_best_as_of(indexed.points(), ["k"], indexed.requests(), reps=9, stream=indexed.stream())
    got = A.fit_best_as_of_short(points, ["k"], wanted, ["t", "n"], reps=9)
    cols = [c for c in got.columns if c != "rdate"]
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect())) and got.count() == 7
