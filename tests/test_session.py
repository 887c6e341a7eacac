"""The shared folder and the key of the stored games."""

import shutil
import tempfile
from types import SimpleNamespace

import pytest

from gamecast import session
from gamecast.sources import testbed

SF = "/root/testdata/sf0.001"


def test_a_cluster_session_without_a_shared_folder_is_refused():
    sc = SimpleNamespace(getConf=lambda: {}, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_materialized_copies_can_be_released(spark):
    path = tempfile.mkdtemp(prefix="gc-release-") + "/t"
    assert session.materialize(spark.range(3), path=path).count() == 3
    session.release(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path).count()


def test_a_rewritten_part_file_gives_new_games(spark):
    base = tempfile.mkdtemp(prefix="gc-key-")
    for t in ("orders", "customer", "supplier", "nation"):
        shutil.copy(f"{SF}/{t}.parquet", f"{base}/{t}.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    lines.write.parquet(f"{base}/lineitem.parquet")
    first = testbed._fingerprint(spark, base)
    assert first == testbed._fingerprint(spark, base)
    n = testbed.stored_games(spark, base).count()
    lines.where("l_orderkey % 2 = 0").write.mode("overwrite").parquet(f"{base}/lineitem.parquet")
    assert testbed._fingerprint(spark, base) != first
    assert testbed.stored_games(spark, base).count() < n
