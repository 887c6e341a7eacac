import json
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from gamecast.functions import parse_ymd, round_half_up
from gamecast.sources import requests as RQ
from gamecast.sources import sinks as SK
from gamecast.streaming import score_request_stream

# Our own sample in the request-file format: 0-based month, escaped apostrophes.
SAMPLE = "BOS\nNYK\nAnn,Bo O\\'Neil,Cy\\'s Kid\nCy,Dee\n2013-0-24"


def _write(d, name, text):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


def test_parse_single_request_file(spark):
    d = tempfile.mkdtemp(prefix="gc-req-")
    _write(os.path.join(d, "request_id=42"), "request.txt", SAMPLE)
    p = RQ.read_requests(spark, d).first()
    assert (p.request_id, p.home_abbr, p.away_abbr) == (42, "BOS", "NYK")
    assert str(p.rdate) == "2013-01-24 00:00:00"
    assert p.home_roster == ["Ann", "Bo O'Neil", "Cy's Kid"] and p.away_roster == ["Cy", "Dee"]
    roster = RQ.roster_table(RQ.read_requests(spark, d))
    assert roster.count() == 5


def test_request_bundle_roundtrip(spark):
    req = spark.createDataFrame([(1, "2013-01-24", "BOS", "NYK"), (2, "2012-12-31", "MIA", "BOS")],
                                "request_id bigint, d string, home_abbr string, away_abbr string")
    req = req.select("request_id", F.col("d").cast("timestamp_ntz").alias("rdate"), "home_abbr", "away_abbr")
    ros = spark.createDataFrame([(1, "home", "Bo O'Neil"), (1, "away", "Cy"), (2, "home", "Dee")],
                                "request_id bigint, side string, player string")
    d = tempfile.mkdtemp(prefix="gc-bundle-")
    RQ.write_requests(RQ.render_requests(req, ros), d + "/b", layout="bundle")
    RQ.write_requests(RQ.render_requests(req, ros), d + "/s", layout="single")
    for sub in ("b", "s"):
        p = RQ.read_requests(spark, f"{d}/{sub}")
        got = sorted((r.request_id, str(r.rdate), r.home_abbr, r.away_abbr) for r in RQ.requests_table(p).collect())
        assert got == [(1, "2013-01-24 00:00:00", "BOS", "NYK"), (2, "2012-12-31 00:00:00", "MIA", "BOS")]
        assert sorted(tuple(r) for r in RQ.roster_table(p).collect()) == sorted(tuple(r) for r in ros.collect())


def test_prediction_files_cap_and_roundtrip(spark):
    preds = spark.range(45).select(F.lit(7).cast("bigint").alias("request_id"),
                                   F.when(F.col("id") < 25, "home").otherwise("away").alias("side"),
                                   F.format_string("p'%02d", "id").alias("player"),
                                   (F.col("id") + F.lit(0.5)).alias("prediction"))
    d = tempfile.mkdtemp(prefix="gc-pred-")
    for layout in ("bundle", "single"):
        SK.write_predictions(preds, f"{d}/{layout}-all", layout=layout)
        assert RQ.read_predictions(spark, f"{d}/{layout}-all").count() == 45          # no cap unless asked for
        SK.write_predictions(preds, f"{d}/{layout}", layout=layout, per_side=20)
        back = RQ.read_predictions(spark, f"{d}/{layout}")
        counts = {r.side: r["count"] for r in back.groupBy("side").count().collect()}
        assert counts == {"home": 20, "away": 20}
        first = back.where("side = 'home' AND line = 1").first()
        assert (first.player, first.prediction, first.pts) == ("p'00", 0.5, 1)


def test_json_response(spark):
    preds = spark.createDataFrame([(1, "home", "A", 2.5), (1, "away", "B", -0.5), (1, "home", "C", 1.49)],
                                  "request_id bigint, side string, player string, prediction double")
    r = json.loads(SK.to_response(preds).first().response)
    assert r == {"success": True, "msg": "", "local": [{"player": "A", "pts": 3}, {"player": "C", "pts": 1}],
                 "visit": [{"player": "B", "pts": 0}]}


def test_scalars(spark):
    r = spark.range(1).select(
        parse_ymd(F.lit("2013-0-24"), zero_based_month=True).alias("a"),
        parse_ymd(F.lit("2013-0-24")).alias("b"),
        parse_ymd(F.lit("2013-11-31"), zero_based_month=True).alias("c"),
        round_half_up(F.lit(-0.5)).alias("h1"), round_half_up(F.lit(2.5)).alias("h2"),
        round_half_up(F.lit(-1.5)).alias("h3")).first()
    assert (str(r.a), r.b, str(r.c), r.h1, r.h2, r.h3) == ("2013-01-24", None, "2013-12-31", 0, 3, -1)


def test_series_writer(spark):
    rows = [("home", 1, "A/B", 1, 5), ("away", 1, "C", 0, 4), ("home", 1, "A/B", 0, 3)]
    hist = spark.createDataFrame(rows, "side string, request_id bigint, player string, idx bigint, pts int")
    d = tempfile.mkdtemp(prefix="gc-series-") + "/s"
    SK.write_series(hist, d)
    assert sorted(f for f in os.listdir(d) if not f.startswith(".")) == ["_SUCCESS", "side=away", "side=home"]
    got = sorted((r.side, int(r.request_id), r.player, r.idx, int(r.pts)) for r in SK.read_series(spark, d).collect())
    assert got == sorted(rows)


def test_predictions_without_a_blank_line_need_the_roster(spark):
    rows = [(1, "home", "A", 1.0), (1, "home", "Both", 2.0), (1, "away", "Both", 3.0), (1, "away", "Z", 4.0), (2, "away", "A", 5.0)]
    preds = spark.createDataFrame(rows, "request_id bigint, side string, player string, prediction double")
    d = tempfile.mkdtemp(prefix="gc-plain-") + "/p"
    SK.write_predictions(preds, d, blank_line=False)
    back = RQ.read_predictions(spark, d, preds.select("request_id", "side", "player"))
    assert sorted(tuple(r)[:2] + (r.player, r.prediction) for r in back.collect()) == sorted(rows)
    with pytest.raises(Exception, match="no blank line"):
        RQ.read_predictions(spark, d).collect()


def test_a_large_bundle_is_read_by_several_tasks(spark):
    req = spark.range(3000).select(F.col("id").alias("request_id"), F.lit("2013-01-24").cast("timestamp_ntz").alias("rdate"),
                                   F.lit("BOS").alias("home_abbr"), F.lit("NYK").alias("away_abbr"))
    ros = req.select("request_id", F.lit("home").alias("side"), F.concat(F.lit("O'"), F.col("request_id").cast("string")).alias("player"))
    d = tempfile.mkdtemp(prefix="gc-split-") + "/b"
    RQ.write_requests(RQ.render_requests(req, ros).coalesce(1), d)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        raw = RQ._read_text(spark, d)
        assert raw.rdd.getNumPartitions() > 3
        p = RQ.read_requests(spark, d)
        assert RQ.requests_table(p).distinct().count() == 3000
        assert sorted(r.player for r in RQ.roster_table(p).collect()) == sorted(f"O'{k}" for k in range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_stream_needs_a_checkpoint_and_takes_stored_models(spark, small_games):
    from gamecast.plans.pipelines import quick_models
    base = tempfile.mkdtemp(prefix="gc-models-")
    _write(f"{base}/in", "r1.txt", "#101\nBOS\nNYK\nAnn\nCy\n2013-1-1")
    with pytest.raises(ValueError):
        score_request_stream(spark, f"{base}/in", small_games, f"{base}/out", checkpoint="")
    quick_models(small_games).write.parquet(f"{base}/models")
    q = score_request_stream(spark, f"{base}/in", None, f"{base}/out", checkpoint=f"{base}/ck",
                             models=spark.read.parquet(f"{base}/models"))
    q.awaitTermination()
    assert sorted(r.player for r in RQ.read_predictions(spark, f"{base}/out").collect()) == ["Ann", "Cy"]


def test_request_stream_is_idempotent_on_restart(spark, small_games):
    base = tempfile.mkdtemp(prefix="gc-stream-")
    _write(f"{base}/in", "r1.txt", "#101\nBOS\nNYK\nAnn\nCy\n2013-1-1")
    _write(f"{base}/in", "r2.txt", "#102\nNYK\nBOS\nCy\nAnn,Nobody\n2013-1-2")
    q = score_request_stream(spark, f"{base}/in", small_games, f"{base}/out", checkpoint=f"{base}/ck")
    q.awaitTermination()
    out = RQ.read_predictions(spark, f"{base}/out")
    got = sorted((r.request_id, r.side, r.player) for r in out.collect())
    assert got == [(101, "away", "Cy"), (101, "home", "Ann"), (102, "away", "Ann"), (102, "home", "Cy")]
    q = score_request_stream(spark, f"{base}/in", small_games, f"{base}/out", checkpoint=f"{base}/ck")
    q.awaitTermination()
    assert RQ.read_predictions(spark, f"{base}/out").count() == 4


def test_team_prediction_file_lines(spark):
    preds = spark.createDataFrame(
        [(3, "away", "NYK", 101.5, 9.25, 0.5), (3, "home", "BOS", 99.0, 8.0, None)],
        "request_id bigint, side string, abbreviation string, prediction double, rmse double, r2 double")
    d = tempfile.mkdtemp(prefix="gc-team-")
    SK.write_team_predictions(preds, d + "/t", layout="single")
    files = [os.path.join(dp, f) for dp, _, fs in os.walk(d + "/t") for f in fs
             if f.startswith("part-") and not f.endswith(".crc")]
    text = "".join(open(f).read() for f in files)
    assert text.strip().split("\n") == ["BOS/99.0/8.0/NaN", "NYK/101.5/9.25/0.5"]


def test_a_single_file_may_hold_lines_that_begin_with_a_hash(spark):
    d = tempfile.mkdtemp(prefix="gc-hash-")
    _write(os.path.join(d, "request_id=5"), "r.txt", "#BOS\n#76\n#Ann,#1\n#Cy\n2013-0-24")
    (p,) = RQ.read_requests(spark, d).collect()
    assert (p.request_id, p.home_abbr, p.away_abbr, p.home_roster, p.away_roster) == (5, "#BOS", "#76", ["#Ann", "#1"], ["#Cy"])
    assert str(p.rdate) == "2013-01-24 00:00:00"
    _write(os.path.join(d, "request_id=6"), "r.txt", "BOS\n\x1e#76\nAnn\nCy\n2013-0-24")
    with pytest.raises(Exception, match="record mark"):
        RQ.read_requests(spark, d).collect()


def test_no_line_of_a_bundle_can_look_like_a_record(spark):
    odd = ["#1", "\x1e#1", "\x1e\x1e#1", "\x1e", "#"]
    req = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate((a, b) for a in odd for b in odd)],
                                "request_id bigint, home_abbr string, away_abbr string")
    req = req.withColumn("rdate", F.lit("2013-01-24").cast("timestamp_ntz"))
    ros = req.select("request_id", F.lit("home").alias("side"), F.col("away_abbr").alias("player"))
    d = tempfile.mkdtemp(prefix="gc-odd-") + "/b"
    RQ.write_requests(RQ.render_requests(req, ros).coalesce(2), d)
    parsed = RQ.read_requests(spark, d)
    want = sorted((r.request_id, r.home_abbr, r.away_abbr, [r.away_abbr]) for r in req.collect())
    assert sorted((r.request_id, r.home_abbr, r.away_abbr, r.home_roster) for r in parsed.collect()) == want


def test_prediction_lines_of_unknown_names_and_by_count(spark):
    d = tempfile.mkdtemp(prefix="gc-unknown-")
    _write(os.path.join(d, "request_id=1"), "p.txt", "Ann/1.5\nGhost/2.0\nCy/3.25")
    roster = spark.createDataFrame([(1, "home", "Ann"), (1, "home", "Bo"), (1, "away", "Cy")], "request_id bigint, side string, player string")
    named = {r.player: r.side for r in RQ.read_predictions(spark, d, roster).collect()}
    assert named == {"Ann": "home", "Ghost": None, "Cy": "away"}
    counted = {r.player: (r.side, r.line) for r in RQ.read_predictions(spark, d, roster, by="count").collect()}
    assert counted == {"Ann": ("home", 1), "Ghost": ("home", 2), "Cy": ("away", 1)}
    with pytest.raises(ValueError):
        RQ.read_predictions(spark, d, roster, by="guess")


def test_models_follow_games_that_arrive(spark, small_games):
    """Two batches of games, one of them again, one late: the models of a full fit of what is in order."""
    from gamecast.plans.pipelines import quick_models
    from gamecast.streaming import latest_models, refresh_models_stream
    base = tempfile.mkdtemp(prefix="gc-arrive-")

    def arrive(games):
        games.coalesce(1).write.mode("append").parquet(f"{base}/games")
        refresh_models_stream(spark, f"{base}/games", f"{base}/models", checkpoint=f"{base}/ck").awaitTermination()

    def same(games):
        cols = ["player", "n", "n_fit", "slope", "intercept", "rmse", "r2", "prediction"]
        got = latest_models(spark, f"{base}/models").select(*cols).collect()
        assert sorted(map(str, got)) == sorted(map(str, quick_models(games).select(*cols).collect()))

    arrive(small_games.where("game_id <= 5"))
    same(small_games.where("game_id <= 5"))
    arrive(small_games.where("game_id > 5 AND game_id <> 8"))
    same(small_games.where("game_id <> 8"))
    arrive(small_games.where("game_id IN (8, 6)"))                    # 8 is late for some players, 6 came before
    models = {r.player: r for r in latest_models(spark, f"{base}/models").collect()}
    assert models["Ann"].n == 9 - 1 + 0 and models["Ann"].late == 2   # game 9 of Ann is later than game 8
    assert models["Flat2"].n == 1 and models["Cy"].late == 1
    before = len(os.listdir(f"{base}/models"))
    refresh_models_stream(spark, f"{base}/games", f"{base}/models", checkpoint=f"{base}/ck").awaitTermination()
    assert len(os.listdir(f"{base}/models")) == before                # nothing new, nothing written
    with pytest.raises(ValueError):
        refresh_models_stream(spark, f"{base}/games", f"{base}/models", checkpoint="")
    # requests are scored with the newest models
    _write(f"{base}/in", "r1.txt", "#101\nBOS\nNYK\nAnn\nCy\n2013-1-1")
    score_request_stream(spark, f"{base}/in", None, f"{base}/out", checkpoint=f"{base}/ck2", models_dir=f"{base}/models").awaitTermination()
    scored = {r.player: r.prediction for r in RQ.read_predictions(spark, f"{base}/out").collect()}
    assert scored == {p: models[p].prediction for p in ("Ann", "Cy")}


def test_records_are_not_shuffled_by_file(spark):
    """Bundles, files of one request and old bundles side by side, with no shuffle of their text."""
    d = tempfile.mkdtemp(prefix="gc-mixed-")
    _write(os.path.join(d, "request_id=42"), "request.txt", SAMPLE)
    _write(d, "bundle.txt", "".join(f"{RQ.RS}#{k}\n{SAMPLE}\n" for k in (1, 2, 3)))
    _write(d, "old.txt", f"#7\n{SAMPLE}\n#8\n{SAMPLE}\r\n")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parsed = RQ.read_requests(spark, d)
        plan = parsed._jdf.queryExecution().sparkPlan().toString()
        got = {r.request_id: (r.home_abbr, r.home_roster, str(r.rdate)[:10]) for r in parsed.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert got == {k: ("BOS", ["Ann", "Bo O'Neil", "Cy's Kid"], "2013-01-24") for k in (1, 2, 3, 7, 8, 42)}
