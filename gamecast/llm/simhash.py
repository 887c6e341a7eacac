"""SimHash near-dedup with pigeonring filtering.

A fingerprint has 64 bits: bit k is set if over half of the hashes of a document's word shingles (repeats included)
have it. Equal fingerprints are one node. Two nodes link at `MAX_BITS` or fewer differing bits.

Candidates come from the pigeonring principle. The 64 bits are a ring of `PARTS` segments. If two fingerprints differ
in at most t bits, then from some segment on, every chain of l consecutive segments has at most ``l * t / PARTS``
differences, for all l. With 5 segments and t = 4 a chain starts with an equal segment, the next has at most one
difference (so one of its halves is equal), and the budgets go on 0, 1, 2, 3, 4. The equal segment and the equal half
are the key that fingerprints are shuffled and sorted by. Within a key, differences are added up along the chain, a
pair is dropped at the first budget it breaks, and the rest get the full Hamming check.

Runs of one key are linked without listing all their pairs: a short run is compared directly, a longer one is searched
breadth first, which gives a spanning forest. A run too long for a task's memory (`RUN_ROWS`) is passed on whole, and
linked by its midpoints: two fingerprints are within 4 bits exactly if both are within 2 of some third one, so each
joins the groups of all values within 2 bits of its own.

Defined cases: a very long text is hashed whole, a word at a time; a bit that is set in exactly half of the hashes is 0;
null and empty texts have fingerprint zero, which links like any other; fewer words than a shingle are
one shingle; repeated rows are in one component; a null doc_id is never a component's id (null where no member has an
id); an empty table gives no rows; other columns are ignored (`keep_first` passes them through and keeps rows with a
null doc_id).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from gamecast.llm.common import fresh, shipped, stored, text_or_empty
from gamecast.llm.components import components

WORDS, MAX_BITS, SEED = 4, 4, 42
WIDTHS = (13, 13, 13, 13, 12)                 # of the ring's segments, from the lowest bit
PARTS = len(WIDTHS)
STARTS = tuple(sum(WIDTHS[:k]) for k in range(PARTS))
BUDGETS = tuple((k + 1) * MAX_BITS // PARTS for k in range(PARTS))
DIRECT_RUN = 48
RUN_ROWS = 50_000


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of UTF-8 text; A-Z are lowered, words are `[^\\x20\\x09-\\x0D]+`."""
    w = text.lower().split()
    if not w:
        return 0
    shingles = map(b" ".join, zip(*(w[k:] for k in range(words)))) if len(w) >= words else [b" ".join(w)]
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    count = np.zeros(64, np.int64)
    for at in range(0, len(h), 4096):
        part = h[at:at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * count > len(h), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, bits): the fingerprint as a signed long."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_buffer().to_pybytes(), words) for t in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), pa.array(np.array(prints, np.uint64).view(np.int64))],
                                  names=["doc_id", "bits"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        kernel, "doc_id long, bits long")


def _segment(bits: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(bits, start).bitwiseAND(F.lit((1 << width) - 1))


def chain_keys(bits: Column) -> Column:
    """The keys of a fingerprint: for each start of a chain, its segment and either half of the next one."""
    keys = []
    for i in range(PARTS):
        j = (i + 1) % PARTS
        low = WIDTHS[j] // 2
        for half, (start, width) in enumerate(((STARTS[j], low), (STARTS[j] + low, WIDTHS[j] - low))):
            keys.append(F.lit((2 * i + half) << 32).bitwiseOR(F.shiftleft(_segment(bits, STARTS[i], WIDTHS[i]), 16))
                        .bitwiseOR(_segment(bits, start, width)))
    return F.array(*keys)


def _chained(x: np.ndarray, start: int | np.ndarray) -> np.ndarray:
    """Whether differences `x` keep the budgets of the chain from segment `start`, and the Hamming bound."""
    parts = [np.bitwise_count((x >> np.uint64(s)) & np.uint64((1 << w) - 1)) for s, w in zip(STARTS, WIDTHS)]
    ok, total = np.ones(x.shape, bool), np.zeros(x.shape, np.uint8)
    for k, budget in enumerate(BUDGETS[:-1]):
        total = total + (parts[(start + k) % PARTS] if np.isscalar(start) else np.choose((start + k) % PARTS, parts))
        ok &= total <= budget
    return ok & (np.bitwise_count(x) <= MAX_BITS)


def _forest(run: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is linked within a long run, one for each node but a tree's first."""
    a, b, rest = [], [], run
    while len(rest):
        front, rest = [rest[:1]], rest[1:]
        while front and len(rest):
            block = front.pop()
            for at in range(0, len(block), 16):
                now = block[at:at + 16]
                ok = _chained(now[:, None] ^ rest[None, :], start)
                hit = ok.any(0)
                if hit.any():
                    a.append(now[ok.argmax(0)[hit]])
                    b.append(rest[hit])
                    front.append(rest[hit])
                    rest = rest[~hit]
    empty = np.empty(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def _link_runs(keys: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within whole runs of equal keys (both arrays sorted by key)."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(first, len(keys)))
    a, b = [], []
    for k in np.flatnonzero(size > DIRECT_RUN):
        run = bits[first[k]:first[k] + size[k]]
        for out, got in zip((a, b), _forest(run, int(keys[first[k]] >> 33))):
            out.append(got)
    left = np.repeat(size, size) - (np.arange(len(keys)) - np.repeat(first, size)) - 1     # rows behind, in the run
    left[np.repeat(size > DIRECT_RUN, size)] = 0
    at = np.flatnonzero(left > 0)
    for d in range(1, DIRECT_RUN):
        if not len(at):
            break
        ok = _chained(bits[at] ^ bits[at + d], keys[at] >> 33)
        a.append(bits[at[ok]])
        b.append(bits[at[ok] + d])
        at = at[left[at] > d]
    empty = np.empty(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def _linker(run_rows: int):
    def batch_of(a: np.ndarray, b: np.ndarray, key: int | None) -> pa.RecordBatch:
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                                pa.array(np.full(len(a), 0 if key is None else key), pa.int64(),
                                         mask=np.full(len(a), key is None))], names=["a", "b", "long_run"])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, bits, passing = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for batch in batches:
            keys = np.concatenate([keys, batch.column("key").to_numpy()])
            bits = np.concatenate([bits, batch.column("bits").to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            if passing is not None:                       # the rest of a run that was too long
                n = int(np.searchsorted(keys, passing, side="right"))
                yield batch_of(bits[:n], bits[:n], passing)
                keys, bits = keys[n:], bits[n:]
                if not len(keys):
                    continue
                passing = None
            last = int(np.searchsorted(keys, keys[-1]))   # the last run may go on
            yield batch_of(*_link_runs(keys[:last], bits[:last]), None)
            keys, bits = keys[last:], bits[last:]
            if len(keys) > run_rows:
                passing = int(keys[0])
                yield batch_of(bits, bits, passing)
                keys, bits = keys[:0], bits[:0]
        if len(keys):
            yield batch_of(*_link_runs(keys, bits), None)

    return kernel


def links(prints: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints (`bits`) within `MAX_BITS` of each other."""
    keyed = prints.select("bits", F.explode(chain_keys(F.col("bits"))).alias("key"))
    found = stored(keyed.repartition("key").sortWithinPartitions("key", "bits")
                   .mapInArrow(_linker(run_rows), "a long, b long, long_run long"), "simhash-links")
    near = found.where(F.col("long_run").isNull()).select("a", "b")
    long_runs = found.where(F.col("long_run").isNotNull())
    if long_runs.isEmpty():
        return near
    flips = [0] + [1 << i for i in range(64)] + [1 << i | 1 << j for i, j in combinations(range(64), 2)]
    masks = F.lit(np.array(flips, np.uint64).view(np.int64))
    midpoints = (long_runs.select(F.col("long_run").alias("key"), F.col("a"), F.explode(masks).alias("mask"))
                 .withColumn("middle", F.col("a").bitwiseXOR(F.col("mask"))))
    least = midpoints.groupBy("key", "middle").agg(F.min("a").alias("b"))
    return near.unionByName(midpoints.join(least, ["key", "middle"]).where("a <> b").select("a", "b").distinct())


def near_duplicates(documents: DataFrame, words: int = WORDS, run_rows: int = RUN_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    prints = stored(fingerprints(documents, words), "simhash-prints")
    nodes = prints.groupBy("bits").agg(F.min("doc_id").alias("least"))
    found = components(links(nodes.select("bits"), run_rows), "simhash-components")
    grouped = nodes.join(found.withColumnRenamed("node", "bits"), "bits", "left").withColumn(
        "component", F.coalesce("component", "bits"))
    ids = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    of_print = grouped.join(ids, "component").select("bits", "component_id")
    return prints.join(of_print, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """The rows of `documents` whose doc_id is their component's id, one each, with all their columns."""
    found = near_duplicates(documents, words).where("doc_id = component_id").select("doc_id")
    row, doc, kept = fresh(documents, "row", "doc", "kept")
    found = stored(found.groupBy("doc_id").agg(F.count("*").alias(row)).withColumnRenamed("doc_id", doc), "simhash-kept")
    keyed = documents.withColumn(kept, F.col("doc_id").cast("long"))
    first = keyed.join(found.select(doc), F.col(kept) == F.col(doc), "left_semi").drop(kept)
    if not found.where(F.col(row) > 1).isEmpty():        # only where ids repeat
        first = first.dropDuplicates(["doc_id"])
    return first.unionByName(documents.where(F.col("doc_id").isNull()))


shipped(__name__)
