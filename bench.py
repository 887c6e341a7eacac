"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs to completion into Spark's no-op sink (the full plan
executes, nothing is collected). `games_build` and `season_build` are the one-off
conversions of the driver tables into the nested games table the queries read
and into the season layout that searches by name and season read.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fit_full", "predict_quick", "predict_best", "team_predict", "contextual_history",
    "predict_context", "search_games", "season_games", "season_search", "actual_vs_predicted",
    "stream_scoring", "predict_quick_as_of", "predict_best_as_of", "team_predict_as_of", "recent_games_as_of",
    "player_match",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from gamecast.plans.queries import QUERIES
    from gamecast.session import local_session
    from gamecast.sources import testbed
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")   # stage/task times without the UI
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir} if log_dir else None
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          app="gamecast-bench", driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                          extra_conf=extra)
    times = {}
    t0 = time.time()
    testbed.stored_games(spark, sf_dir).count()
    times["games_build"] = round(time.time() - t0, 2)
    t0 = time.time()
    testbed.stored_season_games(spark, sf_dir)
    times["season_build"] = round(time.time() - t0, 2)
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 2)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 2), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
