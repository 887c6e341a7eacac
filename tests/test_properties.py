"""Property checks on random inputs (few examples each: every example runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from gamecast.operators import fit as FT
from gamecast.operators.sequence import with_sequence_index

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

series_st = st.dictionaries(
    st.sampled_from(["a", "b", "c", "d", "O'x"]),
    st.lists(st.integers(min_value=0, max_value=60), min_size=1, max_size=40),
    min_size=1, max_size=4)


@SETTINGS
@given(series=series_st, chunk=st.sampled_from([3, 8, 1 << 14]))
def test_kernel_equals_sql_engine(spark, series, chunk):
    rows = [(k, i, y) for k, ys in series.items() for i, y in enumerate(ys)]
    pts = spark.createDataFrame(rows, "player string, idx bigint, pts int")
    ref = FT.fit_best_of(pts, ["player"], engine="sql")
    got = FT.fit_best_of(pts, ["player"], chunk=chunk, dense_index=True)
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


@SETTINGS
@given(days=st.lists(st.tuples(st.sampled_from(["p", "q"]), st.integers(0, 900)), min_size=1, max_size=80))
def test_two_level_index_equals_row_number(spark, days):
    base = dt.datetime(2001, 1, 1)
    rows = [(k, base + dt.timedelta(days=d), gid) for gid, (k, d) in enumerate(days)]
    df = spark.createDataFrame(rows, "player string, date timestamp_ntz, game_id bigint")
    got = with_sequence_index(df, ["player"], ["date", "game_id"])
    ref = df.withColumn("ref", F.row_number().over(Window.partitionBy("player").orderBy("date", "game_id")) - 1)
    j = got.join(ref, ["player", "date", "game_id"])
    assert j.count() == len(rows) and j.where("idx != ref").count() == 0
