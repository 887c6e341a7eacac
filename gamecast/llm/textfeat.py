"""Features of a whole text for the learned quality operators, and the fit of a linear model on all labelled rows.

A feature vector has hashed groups (character 3- and 4-grams, words, word pairs), each as shares of its group, and a
few dense shares: repeated 3-word windows, words like the one before, repeated lines, distinct words, symbols, capitals, digits, punctuation.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gamecast.llm.common import fresh, shipped, stored, text_or_empty

BITS = 13                               # buckets of a hashed group, as a power of two
GROUPS = ("chars3", "chars4", "words1", "words2")
DENSE = ("repeated_windows", "repeated_neighbours", "repeated_lines", "distinct_words", "symbols", "capitals", "digits",
         "stops")
DIM = len(GROUPS) * (1 << BITS) + len(DENSE)
SCALE, DENSE_SCALE = 30.0, 10.0         # bring the shares of hashed groups and the dense ones to like sizes
BLOCK_ROWS = 2_000                      # labelled rows that are fitted together, about
BLOCK_STEPS = 60                        # steps of a block's fit: the mean of several needs less exact ones
PARTNERS = 50                           # rows of the rarer class that a block has, about
SLICE = 1_024                           # weights that are averaged together
SAMPLE_ROWS = 2_000                     # labelled rows of each class that `labelled_sample` takes, at most
SAMPLE_BYTES = 256 << 20                # bytes of features (8 a feature) of a sample, and of rows that are fitted together
SYMBOLS = re.compile(r"[#*$%&|<>]")
FOLDS = 4


class Text:
    """A text's words (`[^\\x20\\x09-\\x0D]+`) and the counts that both rules and features need."""

    def __init__(self, text: str):
        self.text, self.raw = text, text.encode()
        self.words = self.raw.split()                     # bytes split at ASCII white space only
        self.distinct = dict.fromkeys(self.words)
        for k, w in enumerate(self.distinct):
            self.distinct[w] = k
        self.ids = np.fromiter(map(self.distinct.__getitem__, self.words), np.int64, len(self.words))

    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, " \t\n\v\f\r"))

    def symbols(self) -> int:
        return sum(map(self.text.count, "#*$%&|<>"))

    def dup_lines(self) -> tuple[int, int]:
        """(lines with a word that equal an earlier one, lines with a word)."""
        lines = [line for line in self.raw.split(b"\n") if line.split(None, 1)]
        return len(lines) - len(set(lines)), len(lines)

    def repeat_words(self) -> int:
        """Words inside 3-word windows that occur twice or more in the text."""
        n = len(self.ids) - 2
        if n < 2:
            return 0
        a = self.ids
        if len(self.distinct) < 1 << 21:
            windows = (a[:-2] << 42) | (a[1:-1] << 21) | a[2:]
        else:                                             # number the pairs first, so that a window fits 64 bits
            _, pairs = np.unique(a[:-1] * len(self.distinct) + a[1:], return_inverse=True)
            windows = pairs[:-1] * len(self.distinct) + a[2:]
        order = np.argsort(windows, kind="stable")
        same = windows[order[1:]] == windows[order[:-1]]
        twice = np.zeros(n, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(n + 2, bool)
        for k in range(3):
            covered[k:n + k] |= twice
        return int(covered.sum())

    def grams(self) -> list[np.ndarray]:
        """Bucket of every n-gram, one array a group."""
        chars = np.frombuffer(self.text.encode("utf-32-le"), np.uint32)
        shift = np.uint32(32 - BITS)
        mix = np.uint32(2654435761)
        c3 = chars[:-2] * np.uint32(73856093) + chars[1:-1] * np.uint32(19349663) + chars[2:] * np.uint32(83492791)
        c4 = c3[:-1] * np.uint32(31) + chars[3:] * np.uint32(50331653) if len(chars) > 3 else c3[:0]
        of_word = np.fromiter(map(zlib.crc32, self.distinct), np.uint32, len(self.distinct))
        w1 = of_word[self.ids]
        w2 = w1[:-1] * np.uint32(16777619) ^ w1[1:] * np.uint32(2246822519)
        return [(g * mix) >> shift for g in (c3, c4, w1, w2)]

    def dense(self, repeat_words: int, dup_lines: int, lines: int, symbols: int) -> np.ndarray:
        n, chars, text = max(1, len(self.words)), max(1, len(self.text)), self.text
        stops = sum(map(text.count, ".,"))
        raw = np.frombuffer(self.raw, np.uint8)
        capitals, digits = np.count_nonzero((raw - 65) < 26), np.count_nonzero((raw - 48) < 10)
        neighbours = np.count_nonzero(self.ids[1:] == self.ids[:-1])
        return DENSE_SCALE * np.array([repeat_words / n, neighbours / n, dup_lines / max(1, lines), len(self.distinct) / n,
                         min(1.0, 10 * symbols / chars), capitals / chars, digits / chars, stops / n])


def sparse_row(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values) of a text's feature vector."""
    t = Text(text)
    index, value = [], []
    for k, g in enumerate(t.grams()):
        if len(g):
            at, n = np.unique(g, return_counts=True)
            index.append(at.astype(np.int32) + (k << BITS))
            value.append(SCALE * n / len(g))
    dense = t.dense(t.repeat_words(), *t.dup_lines(), t.symbols())
    index.append(np.arange(DIM - len(DENSE), DIM, dtype=np.int32))
    value.append(dense)
    return np.concatenate(index), np.concatenate(value).astype(np.float32)


def linear_score(t: Text, dense: np.ndarray, weights: np.ndarray) -> float:
    """weights . features, without building the vector."""
    s = float(dense @ weights[DIM - len(DENSE):])
    for k, g in enumerate(t.grams()):
        if len(g):
            s += SCALE * float(weights[k << BITS:(k + 1) << BITS][g].sum()) / len(g)
    return s


def raw_score(text: str, weights: np.ndarray) -> float:
    t = Text(text)
    return linear_score(t, t.dense(t.repeat_words(), *t.dup_lines(), t.symbols()), weights)


class Sample:
    """Labelled feature rows in compressed form: those of a block, or a sample."""

    def __init__(self, rows: list, totals: dict[int, int]):
        rows = sorted(rows, key=lambda r: (r["doc_id"], r["quality"]))
        self.label = np.array([r["quality"] for r in rows], np.int64)
        self.fold = np.array([r["fold"] for r in rows], np.int64)
        self.index = np.concatenate([np.frombuffer(r["at"], "<i4") for r in rows]) if rows else np.empty(0, np.int32)
        self.value = np.concatenate([np.frombuffer(r["value"], "<f4") for r in rows]) if rows else np.empty(0, np.float32)
        sizes = [len(r["at"]) // 4 for r in rows]
        self.ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        # what a sampled row stands for, so that shares are those of all labelled rows
        self.weight = np.array([totals[q] / max(1, (self.label == q).sum()) for q in self.label])

    def both(self, rows: np.ndarray) -> bool:
        """Whether the chosen rows have both labels."""
        return len(set(self.label[rows].tolist())) == 2

    def _blocks(self, rows: int = 256) -> Iterator[tuple[int, int, slice]]:
        """Rows in blocks, so that what is computed from them stays small."""
        for at in range(0, len(self.label), rows):
            to = min(at + rows, len(self.label))
            yield at, to, slice(self.ends[at], self.ends[to])

    def scores(self, weights: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.label))
        for at, to, part in self._blocks():
            out[at:to] = np.add.reduceat(self.value[part] * weights[self.index[part]], self.ends[at:to] - self.ends[at])
        return out

    def gradient(self, by_row: np.ndarray) -> np.ndarray:
        out = np.zeros(DIM)
        for at, to, part in self._blocks():
            each = np.repeat(by_row[at:to], np.diff(self.ends[at:to + 1]))
            out += np.bincount(self.index[part], self.value[part] * each, DIM)
        return out


def fold_of(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [sparse_row(t.as_py()) for t in batch.column("text")]
        yield pa.record_batch([*(batch.column(k) for k in ("doc_id", "quality", "fold")),
                               pa.array([a.astype("<i4").tobytes() for a, _ in rows], pa.binary()),
                               pa.array([v.astype("<f4").tobytes() for _, v in rows], pa.binary())],
                              names=["doc_id", "quality", "fold", "at", "value"])


def _usable(labels: DataFrame, held_out: int) -> DataFrame:
    """(doc_id, quality, fold) of the labels to learn from."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
            .where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
            .withColumn("fold", fold_of().cast("int")).where(F.col("fold") != held_out))


def _texts(documents: DataFrame, held_out: int) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).where(
        fold_of() != held_out)


def _sample_rows(documents: DataFrame, labels: DataFrame, held_out: int, per_class: int) -> tuple[DataFrame, dict[int, int], list]:
    """(the chosen rows' features, labelled rows of each class, their order)."""
    usable = _usable(labels, held_out)
    totals = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = None
    for q in (0, 1):
        part = usable.where(F.col("quality") == q).orderBy(*order).limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = (_texts(documents, held_out).join(F.broadcast(chosen), "doc_id")          # the chosen rows are bounded by `per_class`
            .select("doc_id", "quality", "fold", "text")
            .mapInArrow(_sparse, "doc_id long, quality int, fold int, at binary, value binary"))
    return rows, totals, [*order, "quality", "value"]


def _bounded(rows: Iterator[dict], most_rows: int, most_bytes: int) -> list[dict]:
    """The first rows, up to either bound; at least one of each label if there are any."""
    out, size = [], 0
    for r in rows:
        size += 2 * len(r["at"])
        if len(out) >= most_rows or size > most_bytes and len({x["quality"] for x in out}) == 2:
            break
        out.append(r)
    return out


def labelled_sample(documents: DataFrame, labels: DataFrame, held_out: int = 2, per_class: int = SAMPLE_ROWS) -> Sample:
    """At most `per_class` labelled rows of each class, by hash of doc_id, outside the held-out fold, here on the driver.

    Null doc_ids and labels other than 0 and 1 are left out. `fitted` learns from all labelled rows instead.
    """
    rows, totals, order = _sample_rows(documents, labels, held_out, per_class)
    first = rows.orderBy(*order).limit(2 * per_class).toLocalIterator()
    return Sample(_bounded((r.asDict() for r in first), 2 * per_class, SAMPLE_BYTES), totals)


def _groups(rows: Iterator[dict], most_rows: int, most_bytes: int) -> Iterator[tuple[int, int, list[dict]]]:
    """(block, number, rows) of what is fitted together: a block, or its parts where it is larger than both bounds allow.

    Every part has both labels if its block has: a part that lacks one takes some rows of the part before it.
    """
    def partners(group: list[dict], before: list[dict]) -> list[dict]:
        lacks = {0, 1} - {r["quality"] for r in group}
        return group + [r for r in before if r["quality"] in lacks]

    group, before, size, number = [], [], 0, 0
    for r in rows:
        new = bool(group) and r["block"] != group[-1]["block"]
        full = (len(group) >= most_rows or size > most_bytes) and len({x["quality"] for x in group}) == 2
        if new or full:
            yield group[-1]["block"], number, partners(group, before)
            before = [] if new else [r for q in (0, 1) for r in [x for x in group if x["quality"] == q][-PARTNERS:]]
            number = 0 if new else number + 1
            group, size = [], 0
        group.append(r)
        size += 2 * len(r["at"])
    if group:
        yield group[-1]["block"], number, partners(group, before)


def fitted(documents: DataFrame, labels: DataFrame, fit: Callable[[Sample], object], held_out: int = 2,
           block_rows: int = BLOCK_ROWS) -> tuple[np.ndarray | None, tuple[float, float] | None]:
    """(weights, two numbers) of a linear model learned from all labelled rows outside the held-out fold.

    The rows are dealt by hash to blocks of about `block_rows`, each with rows of both classes (a rare class is dealt to
    several). `fit` makes a model of each block in a Spark task (in `BLOCK_STEPS` if there are several), and the weights
    are the mean of the blocks' weights. The two numbers are those of `fit` if there is one block, else None: they are
    found from all rows' `learning_scores`. Only models come to the driver.
    """
    usable = _usable(labels, held_out)
    counts = {r["quality"]: r for r in usable.groupBy("quality").agg(
        F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids")).collect()}
    totals = {q: r["n"] for q, r in counts.items()}
    blocks = max(1, -(-sum(totals.values()) // block_rows))
    copies = {q: min(blocks, -(-PARTNERS * blocks // r["ids"])) for q, r in counts.items()}
    spread = F.when(F.col("quality") == 1, copies.get(1, 1)).otherwise(copies.get(0, 1))
    # there may be as many labels as documents: merged at any size, not sent to every task
    rows = _texts(documents, held_out).join(usable.hint("merge"), "doc_id")
    dealt = (rows.withColumn("block", F.explode(F.transform(F.sequence(F.lit(0), spread - 1), lambda k: F.pmod(
                 F.xxhash64("doc_id") + k, F.lit(blocks)).cast("int"))))
             .repartition("block").sortWithinPartitions("block", F.xxhash64("doc_id", F.lit(1)), "doc_id", "quality", F.xxhash64("text")))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def features():
            for batch in batches:
                for r in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "quality", "fold", "block", "text"))):
                    at, value = sparse_row(r[4])
                    yield {**dict(zip(("doc_id", "quality", "fold", "block"), r)),
                           "at": at.astype("<i4").tobytes(), "value": value.astype("<f4").tobytes()}
        for block, number, group in _groups(features(), 2 * block_rows, SAMPLE_BYTES):
            own = totals if blocks == 1 else dict(Counter(r["quality"] for r in group))
            weights, *two = vars(fit(Sample(group, own)) if blocks == 1 else fit(Sample(group, own), steps=BLOCK_STEPS)).values()
            if weights is None:
                continue
            raw = np.asarray(weights, "<f4")
            parts = [raw[k:k + SLICE].tobytes() for k in range(0, DIM, SLICE)]
            n = len(parts)
            yield pa.record_batch([pa.array([block] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array([len(group)] * n, pa.int64()),
                                   pa.array(range(n), pa.int32()), pa.array(parts, pa.binary()), *(pa.array([float(v)] * n) for v in two)],
                                  names=["block", "number", "n", "slice", "part", "a", "b"])

    models = stored(dealt.select("doc_id", "quality", "fold", "block", "text").mapInArrow(
        learn, "block int, number int, n long, slice int, part binary, a double, b double"), "block-models", sweep=False)
    found = models.where("slice = 0").agg(F.count("*").alias("groups"), F.min("a").alias("a"), F.min("b").alias("b")).first()
    if not found["groups"]:                                    # no block with both labels
        weights, *two = vars(fit(Sample([], totals))).values()
        return weights, tuple(two)

    def mean(part):
        part = part.sort_values(["block", "number"])
        each, n = np.stack([np.frombuffer(p, "<f4") for p in part["part"]]), part["n"].to_numpy()
        whole = each[0] if len(each) == 1 else (n[:, None] * each.astype(float)).sum(0) / n.sum()
        return part.iloc[:1][["slice"]].assign(part=[np.asarray(whole, "<f4").tobytes()])

    means = models.groupBy("slice").applyInPandas(mean, "slice int, part binary").collect()
    weights = np.concatenate([np.frombuffer(r["part"], "<f4") for r in sorted(means, key=lambda r: r["slice"])])
    return weights, (found["a"], found["b"]) if found["groups"] == 1 else None    # one fit has seen all rows


def raw_scores(documents: DataFrame, weights: np.ndarray, *keep: str) -> DataFrame:
    """(doc_id, columns `keep`, raw): weights . features of every whole text."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [raw_score(t.as_py(), weights) for t in batch.column("text")]
            yield pa.record_batch([*(batch.column(k) for k in names), pa.array(raw, pa.float64())], names=[*names, "raw"])

    names = ["doc_id", *keep]
    rows = documents.select(*names, text_or_empty().alias("text"))
    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in names)
    return rows.mapInArrow(kernel, f"{kinds}, raw double")


def learning_scores(raws: DataFrame, labels: DataFrame, held_out: int = 2) -> DataFrame:
    """(raw, quality, fold) of all labelled rows outside the held-out fold; `raws`: (doc_id, raw) of their documents."""
    each = raws.select(F.col("doc_id").cast("long").alias("doc_id"), "raw")
    return stored(each.join(_usable(labels, held_out), "doc_id").select("raw", "quality", "fold"), "learning-scores", sweep=False)


def kth_lowest(scores: DataFrame, k: int, bins: int = 1_000) -> float:
    """The k-th lowest `raw` (from 1), found by counting in ever narrower ranges."""
    low, high = scores.agg(F.min("raw"), F.max("raw")).first()
    while low < high:
        place = F.least(F.floor((F.col("raw") - low) / F.lit(high - low) * bins), F.lit(bins - 1))
        counted = (scores.where(F.col("raw").between(low, high)).groupBy(place.alias("bin"))
                   .agg(F.count("*").alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high")).orderBy("bin").collect())
        for r in counted:
            if k <= r["n"]:
                break
            k -= r["n"]
        low, high = r["low"], r["high"]
    return low


def descend(gradient, dim: int = DIM, steps: int = 120, rate: float = 0.1) -> np.ndarray:
    """Adam on a whole-sample gradient function."""
    w, m, v = np.zeros(dim), np.zeros(dim), np.zeros(dim)
    for k in range(1, steps + 1):
        g = gradient(w)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
    return w


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def filtered(documents: DataFrame, verdict, text_col: str = "text") -> DataFrame:
    """Rows of `documents`, all columns, whose text the Arrow function `verdict` accepts; null texts count as empty."""
    (keep,) = fresh(documents, "keep")
    return documents.withColumn(keep, verdict(text_or_empty(text_col))).where(F.col(keep)).drop(keep)


shipped(__name__)
