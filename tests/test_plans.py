"""Plan shape checks on the stored testbed games (public explain output)."""

import contextlib
import io
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_player_line_scan_is_narrow(spark):
    from gamecast.operators.rows import player_rows
    from gamecast.sources.testbed import stored_games
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    p = plan(player_rows(stored_games(spark, SF)))
    schema = [line for line in p.splitlines() if "ReadSchema" in line][0]
    assert "players:array<struct<player:string,pts:int>>" in schema
    assert "ast:" not in schema and "fg_pct" not in schema


def test_recent_games_are_trimmed_before_the_shuffle(spark):
    from gamecast.operators.history import newest_games
    from gamecast.operators.rows import player_rows
    from gamecast.sources.testbed import stored_games
    p = plan(newest_games(player_rows(stored_games(spark, SF))))
    assert p.count("WindowGroupLimit") >= 2          # partial (map side) and final


@pytest.mark.parametrize("name", ["predict_quick", "predict_best", "team_predict", "season_games",
                                  "contextual_history", "search_games", "season_search"])
def test_no_cartesian_or_nested_loop_joins(spark, name):
    from gamecast.plans.queries import QUERIES
    p = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_stored_games_are_built_once(spark):
    from gamecast.sources.testbed import stored_games
    assert sorted(stored_games(spark, SF).inputFiles()) == sorted(stored_games(spark, SF).inputFiles())
