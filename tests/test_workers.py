"""The Arrow kernel must run when executors cannot import this package
(only the driver has it on its path), as on a cluster without --py-files."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
from gamecast.operators import fit as FT
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
pts = spark.createDataFrame([("a", i, (i * 7) % 11) for i in range(30)], "player string, idx bigint, pts int")
a = FT.fit_best_of(pts, ["player"])
b = FT.fit_best_of(pts, ["player"], engine="sql")
print("DIFF", a.exceptAll(b).count() + b.exceptAll(a).count())
"""


def test_kernel_runs_without_package_on_workers():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    cwd = tempfile.mkdtemp(prefix="gc-workers-")
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "DIFF 0" in out.stdout, out.stdout[-2000:] + out.stderr[-3000:]
