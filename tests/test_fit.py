import math
import tempfile

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Window
from pyspark.sql import functions as F

from gamecast.operators import asof as AO
from gamecast.operators import fit as FT
from gamecast.operators.sequence import with_sequence_index
from gamecast.session import release


def _points(spark, series):
    rows = [(k, i, y) for k, ys in series.items() for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "player string, idx bigint, pts int")


SERIES = {
    "a": [10, 12, 9, 15, 14, 18, 17, 21, 20, 25, 22, 27],
    "flat": [5, 5, 5, 5],
    "one": [7],
    "two": [3, 9],
}


def _ml(df, reg=0.0):
    v = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        df.select(F.col("idx").cast("double").alias("x"), F.col("pts").cast("double").alias("label")))
    m = LinearRegression(maxIter=100, regParam=reg, fitIntercept=True).fit(v)
    return m.coefficients[0], m.intercept, m.summary.rootMeanSquaredError


def test_fit_full_matches_ml(spark):
    pts = _points(spark, SERIES)
    got = {r.player: r for r in FT.fit_full(pts, ["player"]).collect()}
    slope, icpt, rmse = _ml(pts.where("player = 'a'"))
    a = got["a"]
    assert a.slope == pytest.approx(slope, abs=1e-6) and a.intercept == pytest.approx(icpt, abs=1e-6)
    assert a.rmse == pytest.approx(rmse, abs=1e-6)
    assert a.prediction == pytest.approx(icpt + slope * 12, abs=1e-5)
    f = got["flat"]
    assert (f.slope, f.intercept, f.rmse, f.r2, f.prediction) == (0.0, 5.0, 0.0, None, 5.0)
    o = got["one"]
    assert (o.n, o.slope, o.intercept, o.rmse) == (1, 0.0, 7.0, 0.0)
    t = got["two"]
    assert (t.slope, t.intercept, t.rmse, t.r2) == (6.0, 3.0, 0.0, 1.0)


def test_ridge_matches_ml_on_sample(spark):
    pts = _points(spark, {"a": SERIES["a"] * 3})
    sample = FT.split(pts, ["player"])
    slope, icpt, rmse = _ml(sample, reg=0.001)
    r = FT.fit_split(pts, ["player"], reg=0.001).first()
    assert r.n == 36 and r.n_fit == sample.count()
    assert r.slope == pytest.approx(slope, abs=1e-6) and r.intercept == pytest.approx(icpt, abs=1e-6)
    assert r.rmse == pytest.approx(rmse, abs=1e-6)


def test_split_is_about_seventy_percent(spark):
    pts = spark.range(20000).select(F.lit("p").alias("player"), F.col("id").alias("idx"), F.lit(1).alias("pts"))
    frac = FT.split(pts, ["player"]).count() / 20000
    assert 0.68 < frac < 0.72
    for rep in (1, 2, 50):
        frac = FT.split(pts, ["player"], rep=rep).count() / 20000
        assert 0.68 < frac < 0.72


def test_best_of_engines_agree_and_rule(spark):
    pts = _points(spark, {**SERIES, "b": [1, 9, 2, 8, 3, 7, 4, 6, 5, 5, 6, 4, 7, 3]})
    a = FT.fit_best_of(pts, ["player"], engine="arrow")
    s = FT.fit_best_of(pts, ["player"], engine="sql")
    assert a.exceptAll(s).count() == 0 and s.exceptAll(a).count() == 0
    best = {r.player: r for r in a.collect()}
    # a perfect full fit cannot be beaten: the full fit (rep 0) wins ties
    assert best["flat"].rep == 0 and best["two"].rep == 0 and best["one"].rep == 0
    # the kept model has the smallest rmse among all candidates
    sums = FT.rep_sums(pts.where("player = 'b'"), ["player"], engine="sql")
    cands = sums.select("rep", *FT.model_columns(exact=True)).collect()
    m = min(round(c.rmse, 6) for c in cands)
    assert best["b"].rmse == pytest.approx(m, abs=1e-6)
    assert best["b"].rep == min(c.rep for c in cands if round(c.rmse, 6) == m)
    assert best["b"].n == 14


def test_best_of_chunked_series_agree(spark):
    import random
    rnd = random.Random(7)
    series = {f"s{i}": [rnd.randint(0, 40) for _ in range(rnd.randint(1, 30))] for i in range(12)}
    pts = _points(spark, series)
    ref = FT.fit_best_of(pts, ["player"], engine="sql")
    for chunk in (4, 7, 1 << 14):
        for dense in (True, False):
            got = FT.fit_best_of(pts, ["player"], chunk=chunk, dense_index=dense)
            assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_sequence_index_matches_row_number(spark):
    import datetime as dt
    base = dt.datetime(2010, 1, 1)
    rows = [("p" if i % 3 else "q", base + dt.timedelta(days=(i * 7) % 400), i) for i in range(600)]
    df = spark.createDataFrame(rows, "player string, date timestamp_ntz, game_id bigint")
    got = with_sequence_index(df, ["player"], ["date", "game_id"])
    ref = df.withColumn("ref", F.row_number().over(Window.partitionBy("player").orderBy("date", "game_id")) - 1)
    j = got.join(ref, ["player", "date", "game_id"])
    assert j.count() == 600 and j.where("idx != ref").count() == 0


def test_fitted_values(spark):
    pts = _points(spark, {"two": [3, 9]})
    m = FT.fit_full(pts, ["player"], digits=None)
    fv = sorted((r.idx, r.fitted) for r in FT.fitted_values(m, pts, ["player"]).collect())
    assert fv == [(0, 3.0), (1, 9.0)]
    assert not math.isnan(fv[0][1])


def test_null_and_fractional_points(spark):
    """Every engine fits the points there are, fractions included."""
    rows = [("a", k, 2.0 * k + 0.5 if k not in (3, 7) else None) for k in range(10)] + [("none", 0, None)]
    df = spark.createDataFrame(rows, "player string, idx bigint, pts double")
    full = {r.player: r for r in FT.fit_full(df, ["player"]).collect()}
    assert (full["a"].n, full["a"].slope, full["a"].intercept) == (8, 2.0, 0.5) and full["none"].n == 0
    assert FT.fit_split(df, ["player"], reg=0.0).where("player = 'a'").first().slope == 2.0
    for engine, dense in (("sql", False), ("arrow", False), ("arrow", True)):
        best = {r.player: r for r in FT.fit_best_of(df, ["player"], engine=engine, dense_index=dense).collect()}
        assert (best["a"].n, best["a"].slope, best["a"].intercept, best["a"].prediction) == (8, 2.0, 0.5, 16.5)


def test_prefix_fits_are_the_fits_of_the_prefixes(spark):
    import random
    rng = random.Random(1)
    rows = [(p, k, rng.randint(0, 30)) for p in ("a", "b") for k in range(40)]
    df = spark.createDataFrame(rows, "player string, idx bigint, pts int")
    wanted = spark.createDataFrame([(p, n, 100 + n) for p in ("a", "b") for n in (1, 6, 7, 8, 23, 40)],
                                   "player string, before bigint, request_id bigint")
    got = {(r.player, r.request_id): r for r in AO.fit_split_as_of(df, ["player"], wanted, chunk=7).collect()}
    for n in (1, 6, 7, 8, 23, 40):
        for r in FT.fit_split(df.where(f"idx < {n}"), ["player"]).collect():
            g = got[r.player, 100 + n]
            assert (g.n, g.n_fit, g.slope, g.intercept, g.rmse, g.prediction) == (r.n, r.n_fit, r.slope, r.intercept, r.rmse, r.prediction)


def test_best_prefix_fits_are_the_best_fits_of_the_prefixes(spark, monkeypatch):
    """Whatever the chunks and blocks, a cut's model is `fit_best_of` on the points before it."""
    import random
    monkeypatch.setattr(AO, "BLOCK", 5)
    rng = random.Random(2)
    rows = [(p, k, rng.randint(0, 30) if p != "gaps" or k % 4 else None) for p in ("a", "b", "gaps") for k in range(45)]
    df = spark.createDataFrame(rows, "player string, idx bigint, pts int")
    cuts = (0, 1, 2, 7, 8, 14, 29, 45)
    wanted = spark.createDataFrame([(p, n, r) for p in ("a", "b", "gaps") for n in cuts for r in (n, 1000 + n)] + [("none", 3, 1)],
                                   "player string, before bigint, request_id bigint")
    for chunk in (7, 1 << 14):
        got = {(r.player, r.request_id): r for r in AO.fit_best_as_of(df, ["player"], wanted, reps=20, chunk=chunk).collect()}
        want = {}
        for n in cuts[1:]:
            for r in FT.fit_best_of(df.where(f"idx < {n}"), ["player"], reps=20, engine="sql").collect():
                if r.n:
                    want[r.player, n] = r
        assert {(p, n % 1000) for p, n in got} == set(want) and len(got) == 2 * len(want)
        for (p, n), g in got.items():
            r = want[p, n % 1000]
            assert (g.n, g.n_fit, g.rep, g.slope, g.intercept, g.rmse, g.r2, g.prediction) == (
                r.n, r.n_fit, r.rep, r.slope, r.intercept, r.rmse, r.r2, r.prediction)


def test_index_of_a_hot_team_month_is_spread(spark):
    """90 % of the rows are one team's in one month: many partitions share them, and every place is right."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 700)).alias("team"),
        F.expr("timestamp_ntz'2012-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 28 as int))").alias("date"),
        (F.col("id") * 7919 % 20_000).alias("game_id"))
    path = tempfile.mkdtemp(prefix="gc-index-") + "/t"
    got = with_sequence_index(df, ["team"], ["date", "game_id"], path=path)
    parts = {r._part: r["count"] for r in spark.read.parquet(path).where("team = 'hot'").groupBy("_part").count().collect()}
    assert len(parts) >= 6 and max(parts.values()) < 6_000
    ref = df.withColumn("ref", F.row_number().over(Window.partitionBy("team").orderBy("date", "game_id")) - 1)
    j = got.join(ref, "game_id")
    assert j.count() == 20_000 and j.where("idx <> ref").count() == 0
    release(spark, path)


def test_marks_count_the_rows_before_them(spark):
    rows = [(None if k % 5 == 0 else f"p{k % 3}", (k * 37) % 500, k % 4 > 0) for k in range(500)]
    df = spark.createDataFrame(rows, "player string, o int, real boolean")
    got = with_sequence_index(df, ["player"], ["o"], counted="real")
    for r in got.collect():
        assert r.idx == sum(1 for p, o, real in rows if p == r.player and real and o < r.o)


def test_full_fit_reads_its_points_once(spark, small_games):
    from test_plans import plan
    from gamecast.plans import pipelines as PL
    p = plan(FT.fit_full(PL.player_series(small_games), ["player"]))
    assert p.count("\nLocation:") == 1 and p.count("+- Exchange") <= 1


def test_long_series_are_exact_whatever_the_order(spark):
    """2 million points, dealt out in two ways: identical models, equal to whole-number arithmetic."""
    n = 2_000_000
    base = spark.range(n).select(F.lit("p").alias("player"), F.col("id").alias("idx"), (F.col("id") * 7919 % 61).cast("int").alias("pts"))
    one, other = base.repartition(5), base.repartition(13, (F.col("idx") % 101)).orderBy(F.desc("pts"))
    for fit in (FT.fit_full, FT.fit_split, lambda d, k: FT.fit_best_of(d, k, reps=8, dense_index=True)):
        a, b = (fit(d, ["player"]).collect() for d in (one, other))
        assert a == b
    (full,) = FT.fit_full(one, ["player"], digits=None).collect()
    ys = [k * 7919 % 61 for k in range(n)]
    sx, sxx, sy, sxy = n * (n - 1) // 2, (n - 1) * n * (2 * n - 1) // 6, sum(ys), sum(k * y for k, y in enumerate(ys))
    assert full.slope == (n * sxy - sx * sy) / (n * sxx - sx * sx)


def test_runs_under_one_hash_are_kept_apart():
    """Rows of two series whose first hash is equal may alternate, also across frames."""
    import pandas as pd
    seen = []

    def emit(pdf, starts, ends):
        seen.extend((pdf["_g2"][s], sorted(pdf["v"][s:e])) for s, e in zip(starts, ends))
    rows = [(1, 1, 0), (2, 7, 1), (2, 8, 2), (2, 7, 3), (2, 8, 4), (2, 7, 5), (3, 9, 6)]
    frames = [pd.DataFrame(rows[a:b], columns=["_g", "_g2", "v"]) for a, b in ((0, 2), (2, 4), (4, 6), (6, 7), (7, 7))]
    assert list(FT._runs(emit)(frames)) == []
    assert seen == [(1, [0]), (7, [1, 3, 5]), (8, [2, 4]), (9, [6])]


def test_pieces_give_the_fit_of_their_points(spark):
    """Stretches of points, upwards and downwards and over chunk borders, are shuffled as arrays and fitted as their points."""
    rows = [(k, at, step, [(7 * k + 5 * i) % 23 for i in range(n)])
            for k in range(3) for at, step, n in ((0, 1, 5), (11, -1, 7), (12, 1, 9))]
    pieces = spark.createDataFrame(rows, "k long, at long, step long, pts array<int>")
    points = spark.createDataFrame([(k, at + step * i, p) for k, at, step, pts in rows for i, p in enumerate(pts)], "k long, idx long, pts int")
    for chunk in (4, 1 << 14):
        laid = FT.pieces_in_runs(pieces, ["k"], chunk=chunk)
        assert sorted((r.k, r.idx, r.pts) for r in laid.collect()) == sorted(map(tuple, points.collect()))
        got = FT.fit_best_of(laid, ["k"], reps=10, dense_index=True, chunk=chunk, in_runs=True)
        assert sorted(got.collect()) == sorted(FT.fit_best_of(points, ["k"], reps=10, dense_index=True, chunk=chunk).collect())
