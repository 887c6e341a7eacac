"""Session helpers. Library code never sets `master`; callers own the session."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on: UTC wall clock for NTZ arithmetic, AQE for
# runtime re-planning (broadcast of small shuffled sides, partition coalescing,
# skew-join splitting).
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    On a cluster this must be set by the deployment (a shared file system); a
    session without it gets an error. Only a local session, where the driver
    and the executor are one process, gets a scratch folder when it is unset.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="gamecast-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "gamecast", driver_memory: str = "8g",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench (not for library code)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", driver_memory)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**RECOMMENDED_CONF, **(extra_conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def release(spark: SparkSession, path: str) -> None:
    """Remove a written copy (`materialize(..., path=...)`) that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, name: str = "table", path: str | None = None) -> DataFrame:
    """Write `df` once as a Parquet table in the shared checkpoint folder (or at
    `path`, which `release` can remove) and continue from the written table.

    Cuts the lineage of long plans that are read more than once and survives
    the loss of executors (unlike a local checkpoint); columnar, so later
    reads prune columns.
    """
    import uuid

    spark = df.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
