import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) >= {"request_id", "side", "player", "prediction"}
    assert df.count() > 0
