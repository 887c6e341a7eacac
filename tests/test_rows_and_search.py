from pyspark.sql import functions as F

from gamecast.operators import rows as R
from gamecast.operators import search as S
from gamecast.schema import seasons_dim


def test_player_rows_sides_and_positions(small_games):
    rows = {(r.game_id, r.player): r for r in R.player_rows(small_games).collect()}
    # game 2: home (NYK) sits at position 1
    r = rows[(2, "Cy")]
    assert (r.side, r.bpos, r.team, r.opponent, r.home_abbr, r.away_abbr) == ("home", 1, "NYK", "BOS", "NYK", "BOS")
    r = rows[(2, "Ann")]
    assert (r.side, r.bpos, r.ppos, r.won) == ("away", 0, 0, 1)
    assert rows[(2, "Bo O'Neil")].ppos == 1


def test_empty_and_missing_boxes_give_no_rows(small_games):
    rows = R.player_rows(small_games)
    assert rows.where("game_id = 3").count() == 1          # away box empty
    g7 = rows.where("game_id = 7").collect()                # home box missing
    assert [(r.player, r.side) for r in g7] == [("Ann", "away")]


def test_player_prefilter_matches_filter_after_unnest(small_games):
    pre = R.player_rows(small_games, players=["Ann", "Cy"]).collect()
    post = R.player_rows(small_games).where(F.col("player").isin("Ann", "Cy")).collect()
    assert sorted(pre) == sorted(post)


def test_team_rows_self_play_gives_two_rows(small_games):
    t = R.team_rows(small_games).where("game_id = 9").collect()
    assert sorted((r.abbreviation, r.side) for r in t) == [("BOS", "away"), ("BOS", "home")]


def test_rosters_from_games(small_games):
    requests, roster, actual = R.rosters_from_games(small_games)
    req = {r.request_id: r for r in requests.collect()}
    assert (req[2].home_abbr, req[2].away_abbr) == ("NYK", "BOS")
    got = sorted((r.side, r.player, r.pts) for r in actual.where("request_id = 8").collect())
    assert got == [("away", "Cy", 15), ("away", "Flat2", 8), ("home", "Ann", 24), ("home", "Flat", 5)]


def test_search_games_home_away_and_half_open_range(small_games):
    found = S.search_games(small_games, "BOS", "NYK", "2012-01-01", "2013-01-24")
    assert [r.game_id for r in found.collect()] == [1, 5, 6]
    assert S.search_games(small_games, "BOS", "NYK", limit=2).count() == 2


def test_season_window_bounds(spark, small_games):
    start, end = S.season_window("2011-2012")
    r = spark.range(1).select(start.alias("s"), end.alias("e")).first()
    assert (str(r.s), str(r.e)) == ("2011-10-01 00:00:00", "2012-04-30 00:00:00")
    # 30 April is outside the season, 1 October opens the next one
    found = {r.game_id for r in S.search_games(small_games, "MIA", "BOS", season="2011-2012").collect()}
    assert found == set()
    per = {r.season: r.games for r in S.season_games(small_games).collect()}
    assert per == {2011: 3, 2012: 5}


def test_seasons_dim(spark):
    rows = seasons_dim(spark).collect()
    assert len(rows) == 29
    assert (rows[0].label, rows[0].value) == ("Temporada 12/13", "2012-2013")
    assert (rows[-1].label, rows[-1].value) == ("Temporada 84/85", "1984-1985")
    assert any(r.label == "Temporada 99/00" for r in rows)


def test_read_games_json_and_core_schema(spark, small_games):
    import tempfile

    from gamecast.sources.games import read_games
    d = tempfile.mkdtemp(prefix="gc-json-") + "/g"
    small_games.write.json(d)
    full = read_games(spark, d, format="json")
    assert sorted(full.collect()) == sorted(small_games.collect())
    core = read_games(spark, d, format="json", core=True)
    got = sorted(tuple(r) for r in R.player_rows(core).collect())
    ref = sorted(tuple(r) for r in R.player_rows(small_games).collect())
    assert got == ref


def test_search_games_batch(spark, small_games):
    searches = spark.createDataFrame(
        [(1, "BOS", "NYK", "2012-01-01", "2013-01-24"), (2, "BOS", "NYK", "2000-01-01", "2030-01-01"),
         (3, "MIA", "BOS", "2011-10-01", "2012-04-30")],
        "search_id int, home string, away string, start string, end string")
    searches = searches.select("search_id", "home", "away", F.col("start").cast("timestamp_ntz").alias("start"),
                               F.col("end").cast("timestamp_ntz").alias("end"))
    got = S.search_games_batch(small_games, searches, limit=3).collect()
    by = {}
    for r in got:
        by.setdefault(r.search_id, []).append((r.rank, r.game_id))
    assert sorted(by[1]) == [(1, 1), (2, 5), (3, 6)]
    assert sorted(by[2]) == [(1, 1), (2, 5), (3, 6)]      # capped at 3; game 8 is fourth
    assert 3 not in by                                      # 30 April is outside the window


def test_seasons_come_from_the_games(spark, make_games):
    from conftest import game
    games = make_games([game(1, "2013-11-02", "BOS", "NYK", [("Ann", 1)], None), game(2, "1950-01-02", "BOS", "NYK", [("Ann", 1)], None)])
    got = {r.season: (r.label, r.value, r.games) for r in S.season_games(games).collect()}
    assert got == {2013: ("Temporada 13/14", "2013-2014", 1), 1949: ("Temporada 49/50", "1949-1950", 1)}
    assert S.season_games(games, seasons_dim(spark)).count() == 0


def test_batch_search_over_several_years(spark, small_games):
    s = spark.createDataFrame([(1, "BOS", "NYK", "2011-06-01", "2013-06-01")], "search_id bigint, home string, away string, s string, e string")
    s = s.select("search_id", "home", "away", F.col("s").cast("timestamp_ntz").alias("start"), F.col("e").cast("timestamp_ntz").alias("end"))
    got = [r.game_id for r in sorted(S.search_games_batch(small_games, s).collect(), key=lambda r: r["rank"])]
    assert got == [1, 5, 6, 8]


def _season_layout(spark, make_games):
    """Forty seasons; each player is on the field in one of them."""
    import tempfile

    from conftest import game
    from gamecast.sources.layout import read_season_games, write_season_games
    gs = [game(10 * y + k, f"{1960 + y}-{month:02d}-05", "BOS" if y % 2 else "MIA", "NYK", [(f"P{y}", k + 1)], [("Ever", k)])
          for y in range(40) for k, month in enumerate((10, 12, 3, 7))]
    games = make_games(gs)
    path = tempfile.mkdtemp(prefix="gc-seasons-") + "/g"
    write_season_games(games, path)
    return games, read_season_games(spark, path, core=False)


def test_season_layout_reads_what_a_search_needs(spark, make_games):
    from test_plans import plan
    games, stored = _season_layout(spark, make_games)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    for names in (["P7"], ["P7", "P8", "nobody"], ["Ever"], ["nobody"]):
        assert rows(stored.player_rows(names)) == rows(R.player_rows(games, players=names))
    for abbrs in (["MIA"], ["BOS", "NYK"], ["XXX"]):
        assert rows(stored.team_rows(abbrs)) == rows(R.team_rows(games, abbrs=abbrs))
    assert _files_read(spark, stored.player_rows(["P7"])) <= 2 < _files_read(spark, R.player_rows(stored.games, players=["P7"]))
    want = [r.game_id for r in S.search_games(games, "BOS", "NYK", season="1967-1968").collect()]
    one = stored.search("BOS", "NYK", "1967-1968")
    assert [r.game_id for r in one.collect()] == want == [70, 71]
    assert _files_read(spark, one) == 1


def _files_read(spark, df):
    """Game files that running `df` reads, from the scan's metrics."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        df.collect()
        leaves, n = df._jdf.queryExecution().executedPlan().collectLeaves(), 0
        for k in range(leaves.size()):
            leaf = leaves.apply(k)
            if "/games" in leaf.toString() and leaf.metrics().contains("numFiles"):
                n += leaf.metrics().apply("numFiles").value()
        return n
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_batch_search_prunes_seasons_at_run_time(spark, make_games):
    from test_plans import plan
    games, stored = _season_layout(spark, make_games)
    searches = spark.createDataFrame([(1, "BOS", "NYK", 1967), (2, "MIA", "NYK", 1970), (3, "MIA", "NYK", 1800)],
                                     "search_id bigint, home string, away string, season int")
    found = stored.search_batch(searches, ["search_id"])
    assert "dynamicpruning" in plan(found.where("search_id > 0")).lower()
    start, end = S.season_window(F.concat_ws("-", F.col("season").cast("string"), (F.col("season") + 1).cast("string")))
    ref = S.search_games_batch(games, searches.select("search_id", "home", "away", start.alias("start"), end.alias("end")))
    pick = lambda df: sorted((r.search_id, r["rank"], r.game_id) for r in df.collect())
    assert pick(found) == pick(ref) and len(pick(found)) >= 4


def test_listed_games_and_comparison(spark, make_games):
    from conftest import game
    from gamecast.plans import pipelines as PL
    from gamecast.schema import seasons_dim, teams_dim
    games = make_games([game(1, "2012-11-02", "BOS", "NYK", [("Ann", 1)], None), game(2, "2013-11-02", "BOS", "NYK", [("Ann", 1)], None),
                        game(3, "2012-07-02", "BOS", "NYK", [("Ann", 1)], None), game(4, "2012-11-02", "B", "NYK", [("Ann", 1)], None)])
    got = {r.game_id: (r.label, r.home_name, r.away_name, r.listed) for r in PL.listed_games(games, teams_dim(spark), seasons_dim(spark)).collect()}
    assert got == {1: ("Temporada 12/13", "Boston Celtics", "New York Knicks", True), 2: (None, "Boston Celtics", "New York Knicks", False),
                   3: (None, "Boston Celtics", "New York Knicks", False), 4: ("Temporada 12/13", None, "New York Knicks", False)}
    compared = spark.createDataFrame([(1, "home", "Zed", 3, 4), (1, "home", "Ann", 5, None), (1, "away", "Cy", 0, 2)],
                                     "request_id bigint, side string, player string, actual bigint, predicted bigint")
    assert {r.side: r.lines for r in PL.comparison_text(compared).collect()} == {"home": "Ann 5 -\nZed 3 4", "away": "Cy 0 2"}


def test_batch_search_meets_no_more_games_than_it_lists(spark, make_games):
    """A search with many games in its window looks up the places it lists, by index, not the games of the window."""
    from conftest import game
    from test_plans import plan
    games = make_games([game(k, f"2012-{1 + k % 12:02d}-{1 + k % 28:02d}", "BOS", "NYK", [("Ann", k)], None) for k in range(60)])
    g = R.game_summary(games)
    searches = g.select(F.col("game_id").alias("search_id"), F.col("home_abbr").alias("home"), F.col("away_abbr").alias("away"),
                        F.lit("2012-01-01").cast("timestamp_ntz").alias("start"), F.col("date").alias("end"))
    none = [(100, "BOS", "NYK", None, "2013-01-01"), (101, "BOS", "NYK", "2013-01-01", "2012-01-01"), (102, None, "NYK", "2012-01-01", "2013-01-01")]
    none = spark.createDataFrame(none, "search_id bigint, home string, away string, start string, end string")
    searches = searches.unionByName(none.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")}))
    found = S.search_games_batch(games, searches, limit=2, columns=["game_id", "date"])
    dated = sorted((r.date, r.game_id) for r in g.collect())
    want = sorted((key, k + 1, i) for d, key in dated for k, (_, i) in enumerate([x for x in dated if x[0] < d][:2]))
    assert sorted((r.search_id, r["rank"], r.game_id) for r in found.collect()) == want
    assert any("idx" in line for line in plan(found).splitlines() if line.startswith("Left keys"))


def test_season_layout_shuffles_no_game(spark, make_games):
    """Every task writes its own games: four partitions of one season are four files; equal key rows are one."""
    import glob
    import tempfile

    from conftest import game
    from gamecast.sources.layout import read_season_games, write_season_games
    gs = [game(k % 30, f"2012-11-{k % 30 + 1:02d}", "BOS", "NYK", [("Ann", k), ("Ann", k)], [("Cy", 1)]) for k in range(40)]
    games, path = make_games(gs), tempfile.mkdtemp(prefix="gc-seasons-") + "/g"
    write_season_games(games.repartition(4, "game_id"), path)
    assert len(glob.glob(f"{path}/games/season=2012/*.parquet")) == 4
    stored = read_season_games(spark, path, core=False)
    assert sorted(map(str, stored.games.drop("season").collect())) == sorted(map(str, games.collect()))
    assert sorted(tuple(r) for r in stored.players.collect()) == [(p, 2012, k) for p in ("Ann", "Cy") for k in range(30)]
    assert stored.teams.count() == 60


def test_games_build_moves_no_box_for_a_team(spark):
    """Customers and suppliers too many to broadcast are joined to narrow rows, before the lines of an order are gathered."""
    import datetime as dt
    import tempfile

    from gamecast.sources import testbed
    d = tempfile.mkdtemp(prefix="gc-tables-")
    tables = {
        "nation": ([(0, "N0"), (1, "N1")], "n_nationkey int, n_name string"),
        "customer": ([(1, 0), (2, 1), (None, 0)], "c_custkey bigint, c_nationkey int"),
        "supplier": ([(7, 1), (8, 0)], "s_suppkey bigint, s_nationkey int"),
        "orders": ([(k, c, dt.datetime(1995, 1, k)) for k, c in ((1, 1), (2, 2), (3, 9), (4, 1), (5, None))],
                   "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"),
        "lineitem": ([(1, 8, 1, 5, 1.0, 3.0, "F"), (1, 7, 2, 5, 1.0, 4.0, "O"), (1, 8, 1, 4, 1.0, 9.0, "F"), (2, 8, 1, 5, 1.0, None, "F"),
                      (2, None, 2, 5, 1.0, 2.0, "O"), (3, 7, 1, 5, 1.0, 1.0, "F"), (5, 7, 1, 5, 1.0, 1.0, "F"), (None, 7, 1, 5, 1.0, 1.0, "F")],
                     "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_partkey bigint, l_extendedprice double, l_quantity double, l_linestatus string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        games = testbed.games(spark, d)
        lines = games._jdf.queryExecution().sparkPlan().toString().split("\n")
        got = {r.game_id: r for r in games.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    joins = [k for k, line in enumerate(lines) if "Join" in line and ("o_custkey" in line or "away_supp" in line)]
    assert len(joins) == 2
    for k in joins:
        below = next((i for i in range(k + 1, len(lines)) if depth(lines[i]) <= depth(lines[k])), len(lines))
        assert not any("collect_list" in line for line in lines[k:below])
    assert sorted(got) == [1, 2]
    one, two = got[1], got[2]
    assert [(t.abbreviation, t.home, t.score, t.won) for t in one.teams] == [("N1", False, 4, 0), ("N0", True, 12, 1)]
    assert [[(p.player, p.pts, p.ast) for p in b.players] for b in one.box] == [[("7", 4, None)], [("8", 9, None), ("8", 3, None)]]
    assert [(t.abbreviation, t.score) for t in two.teams] == [("N1", None), ("N0", 2)]
    assert [[(p.player, p.pts) for p in b.players] for b in two.box] == [[("8", None)], [(None, 2)]]
