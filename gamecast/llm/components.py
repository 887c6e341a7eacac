"""Connected components of a link table by alternating large and small stars, as DataFrame joins and groupings.

Each round hangs every node below the smallest node known near it (large star: larger neighbours move to the smallest
neighbour; small star: smaller neighbours do). After a number of rounds that grows with the logarithm of the nodes,
every component is a star around its smallest node. Minima are pre-aggregated before they are shuffled, and the
node with many links is a join key that adaptive execution can split. Every round's table is written to the shared
folder, so a lost executor costs a task and not the loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gamecast.llm.common import release, shared_path, stored


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of `links` (columns a, b of one orderable type), component: its smallest node.

    Rows with a null or with a = b say nothing and are ignored; nodes without a link to another are not returned.
    """
    spark = links.sparkSession
    edges = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    path = shared_path(spark, name)
    edges = stored(edges, name, path, sweep=False)
    mark = _mark(edges)
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.where(F.col("v") > F.col("u")).join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .unionByName(down.select(F.col("u").alias("a"), F.col("m").alias("b")))
                 .where(F.col("a") != F.col("b")).distinct())
        new_path = shared_path(spark, name)
        edges = stored(small, name, new_path, sweep=False)
        new = _mark(edges)
        release(spark, path)
        path = new_path
        if new == mark:
            break
        mark = new
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
