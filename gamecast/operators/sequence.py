"""H1/H2: 0-based position of each point within its series.

A plain `row_number() over (partition by key order by ...)` sorts a whole
series inside one task, so one hot player or team would land on a single
executor. Here the index is a distributed prefix count, made in one pass:

  1. the rows are range-partitioned by key AND order over sampled splits, so
     a long series simply spans several partitions, whatever its dates are;
  2. while a partition streams by in that order, each row gets its place
     within (partition, key); rows and places are written once;
  3. only a key that began in an earlier partition needs an offset, and that
     is the first key of a partition: one row per partition is read back, and
     the offsets (at most one row per partition) are added on read.

Rows may be *marks* that are placed but not counted (`counted`): a mark's
index is the number of counted rows of its key before it. As-of questions are
marks at the request's date, so their cut points come out of the same pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize


def _place_kernel(keys: list[str]):
    """Add `_part` and `_at`, the counted rows of the key before this one in the partition
    (runs inside mapInArrow; rows of a partition arrive in order)."""

    def differs(column):
        """Whether each value differs from the one before it (nulls are equal)."""
        import pyarrow.compute as pc
        a, b = column.slice(1), column.slice(0, len(column) - 1)
        same_null = pc.and_(pc.is_null(a), pc.is_null(b))
        return pc.if_else(same_null, False, pc.fill_null(pc.not_equal(a, b), True)).to_numpy(zero_copy_only=False)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        last, carried = None, 0            # the last key seen, and its counted rows so far
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            starts = np.zeros(n, bool)
            for k in keys:
                starts[1:] |= differs(batch.column(k))
            first = tuple(batch.column(k)[0].as_py() for k in keys)
            goes_on = first == last
            counted = batch.column("_counted").to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.cumsum(counted) - counted
            starts[0] = True
            base = before[starts][np.cumsum(starts) - 1]
            at = before - base
            second = np.flatnonzero(starts)[1] if starts.sum() > 1 else n
            if goes_on:
                at[:second] += carried
            last = tuple(batch.column(k)[n - 1].as_py() for k in keys)
            carried = int(at[-1] + counted[-1])
            names = [f for f in batch.schema.names if f != "_counted"]
            yield pa.record_batch([batch.column(f) for f in names] + [pa.array(np.full(n, part, np.int32)), pa.array(at), pa.array(at + counted)],
                                  names=names + ["_part", "_at", "_upto"])
    return run


def _offsets(edges: list, keys: list[str]) -> list[tuple]:
    """(part, first key..., rows of that key in earlier parts) where that is not 0.

    `edges`: per part its first and last key and the counted rows of the last one.
    """
    out, running = [], {}
    for e in sorted(edges, key=lambda e: e["_part"]):
        first, last = (tuple(e[s][k] for k in keys) for s in ("first", "last"))
        before = running.get(first, 0)
        if before:
            out.append((e["_part"], *first, before))
        running = {last: e["last"]["_upto"] + (before if first == last else 0)}
    return out


def with_sequence_index(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "idx",
                        counted: str | None = None, path: str | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """Add `name` = position (0, 1, 2, ...) of each row within `keys` by `order`.

    The order must be unique within a key for a deterministic index. Rows whose
    boolean column `counted` is false (or null) are marks: they count nothing and
    get the number of counted rows before them. With `keep`, only these columns and the keys go on: the others are not
    written, and move only as far as they order the rows.

    The indexed rows are written once, in the session's shared checkpoint folder
    or at `path` (`session.release` removes it), which takes the one job that
    this function runs; what is returned reads them, and may be used many times.
    """
    keys, spark = list(keys), df.sparkSession
    # a column of `df` orders as it is; only an expression needs a column of its own
    made = {f"_o{i}": o if isinstance(o, Column) else F.col(o) for i, o in enumerate(order) if isinstance(o, Column) or o not in df.columns}
    onames = [f"_o{i}" if f"_o{i}" in made else o for i, o in enumerate(order)]
    kept = df.columns if keep is None else [*keys, *[c for c in keep if c not in keys]]
    moved = list(dict.fromkeys([*kept, *keys, *[o for o in onames if o not in made]]))
    rows = df.select(*moved, F.coalesce(F.col(counted), F.lit(False)).alias("_counted") if counted else F.lit(True).alias("_counted"),
                     *[o.alias(n) for n, o in made.items()])
    # a fixed number of partitions, so that no partition is merged with another and each is one range
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [*keys, *onames]
    ranged = rows.repartitionByRange(parts, *sort).sortWithinPartitions(*sort).select(*kept, "_counted")
    schema = T.StructType([f for f in ranged.schema.fields if f.name != "_counted"] + [
        T.StructField("_part", T.IntegerType()), T.StructField("_at", T.LongType()), T.StructField("_upto", T.LongType())])
    placed = materialize(ranged.mapInArrow(_place_kernel(keys), schema), "indexed", path)
    # One row per partition: the first key, and the last one with its rows so far.
    edges = placed.groupBy("_part").agg(F.min(F.struct(*keys)).alias("first"),
                                        F.max(F.struct(*keys, "_upto")).alias("last")).collect()
    offsets = _offsets(edges, keys)
    at = F.col("_at")
    if offsets:
        key_fields = [T.StructField(f"__ix_k{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
        table = spark.createDataFrame(offsets, T.StructType(
            [T.StructField("__ix_p", T.IntegerType())] + key_fields + [T.StructField("__ix_before", T.LongType())]))
        same = F.col("_part") == F.col("__ix_p")
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"__ix_k{i}"))
        # at most one row per partition of the index
        placed = placed.join(F.broadcast(table), same, "left")
        at = at + F.coalesce("__ix_before", F.lit(0))
    return placed.select(*kept, at.cast("bigint").alias(name))
