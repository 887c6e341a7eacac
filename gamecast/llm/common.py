"""Helpers the training-data operators share: shared-folder tables, shipping kernels to workers, documents."""

from __future__ import annotations

import gc
import sys
import types
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gamecast.session import checkpoint_dir


def shipped(module_name: str) -> None:
    """Pickle a kernel module's functions by value, so Python workers need not import this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def process_cache() -> dict:
    """What this worker process keeps between tasks: loaded vocabularies and bounded memo tables."""
    name = "_gamecast_llm_process_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that the driver and all executors share (`spark.checkpoint.dir`)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, path: str | None = None, sweep: bool = True) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: cuts the lineage and survives lost executors.

    The driver's garbage is collected afterwards, so that Spark drops the shuffle files the write no longer needs
    (`sweep=False` where they are small and the call is repeated).
    """
    spark = df.sparkSession
    path = path or shared_path(spark, name)
    schema = df.schema
    df.write.mode("overwrite").parquet(path)
    del df
    if sweep:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Remove a table that `stored` wrote and nothing reads any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like `names` that `df` does not have (Spark compares names without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


shipped(__name__)
