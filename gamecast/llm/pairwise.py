"""Quality classifier by Bradley-Terry pairwise ranking.

A pair is a document labelled good and one labelled bad. The model gives every document a score (a linear function of
its features) such that sigmoid(score of the better - score of the worse) is likely: logistic loss on the difference
of the two feature vectors. All labelled rows outside the held-out fold are learned from: they are dealt to blocks, the
loss runs over all pairs of a block, and the weights are the mean of the blocks' (`textfeat.fitted`). A document is
accepted if its score lies above a quantile of all learning rows' scores, the share of bad labels among them. Scores
are reported on a 0 to 1 scale on which that quantile is `ACCEPT_AT`.

Defined cases: null and empty texts are scored by their (empty) features; without labels of both classes there is
nothing to rank, and every document gets `ACCEPT_AT`; repeated rows are each scored; an empty table gives no rows;
other columns are ignored (`keep_documents` passes them through). Equal scores at the quantile are cut alike. Very long
texts are scored and learned from whole; a block of more than `textfeat.SAMPLE_BYTES` of features is fitted in parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gamecast.llm.common import shipped, stored, text_or_empty
from gamecast.llm.textfeat import DIM, Sample, descend, filtered, fitted, fold_of, kth_lowest, learning_scores, raw_score, raw_scores, sigmoid

ACCEPT_AT = 0.7
HELD_OUT = 2
SCORED = "held_out boolean, score double, predicted int"


@dataclass
class Ranker:
    """report = sigmoid(slope * (weights . features - cut) + logit(ACCEPT_AT)); no weights: nothing was learned."""
    weights: np.ndarray | None = None
    cut: float = 0.0
    slope: float = 1.0


def fit(sample: Sample, pairs: int | None = None, penalty: float = 1e-4, steps: int = 120) -> Ranker:
    """The ranking of a sample, over all its pairs, or over `pairs` drawn ones if that is fewer."""
    if not sample.both(np.ones(len(sample.label), bool)):
        return Ranker()
    good, bad = np.flatnonzero(sample.label == 1), np.flatnonzero(sample.label == 0)
    rng = np.random.default_rng(7)
    n = len(good) * len(bad) if pairs is None else min(pairs, len(good) * len(bad))
    better, worse = (None, None) if pairs is None else (rng.choice(good, n), rng.choice(bad, n))
    rows = len(sample.label)

    def pulls(s: np.ndarray) -> np.ndarray:
        """Derivative of the logistic loss in each row's score, over its pairs."""
        if pairs is not None:
            pull = sigmoid(s[better] - s[worse]) - 1
            return np.bincount(better, pull, rows) - np.bincount(worse, pull, rows)
        out = np.zeros(rows)
        for at in range(0, len(good), 256):
            some = good[at:at + 256]
            pull = sigmoid(s[some][:, None] - s[bad][None, :]) - 1
            out[some] += pull.sum(1)
            out[bad] -= pull.sum(0)
        return out

    def gradient(w: np.ndarray) -> np.ndarray:
        return sample.gradient(pulls(sample.scores(w)) / n) + penalty * w

    weights = descend(gradient, DIM, steps)
    scores = sample.scores(weights)
    cut = quantile_cut(scores, sample.weight, sample.weight[sample.label == 0].sum() / sample.weight.sum())
    apart = scores[good].mean() - scores[bad].mean()
    return Ranker(weights.astype(np.float32), float(cut), float(8 / max(apart, 1e-9)))


def learned(documents: DataFrame, labels: DataFrame) -> Ranker:
    """The ranking of all labelled rows."""
    weights, numbers = fitted(documents, labels, fit, HELD_OUT)
    if numbers is None:
        raws = raw_scores(documents.where(fold_of() != HELD_OUT), weights)
        numbers = cut_and_slope(learning_scores(raws, labels, HELD_OUT))
    return Ranker(weights, *numbers)


def cut_and_slope(scores: DataFrame) -> tuple[float, float]:
    """`fit`'s two numbers, from the scores (raw, quality) of all learning rows."""
    r = scores.agg(F.count("*").alias("n"), F.count_if(F.col("quality") == 0).alias("bad"),
                   F.avg(F.when(F.col("quality") == 1, F.col("raw"))).alias("good_mean"),
                   F.avg(F.when(F.col("quality") == 0, F.col("raw"))).alias("bad_mean")).first()
    k = min(max(r["bad"], 1), r["n"] - 1)
    apart = round(r["good_mean"] - r["bad_mean"], 9)          # sums in any order give the same digits
    return (kth_lowest(scores, k) + kth_lowest(scores, k + 1)) / 2, 8 / max(apart, 1e-9)


def quantile_cut(scores: np.ndarray, weight: np.ndarray, share: float) -> float:
    """Half way between the last score inside the lowest `share` of the weight and the next one."""
    order = np.argsort(scores, kind="stable")
    reached = np.cumsum(weight[order]) / weight.sum()
    k = int(np.searchsorted(reached, share * (1 + 1e-9), side="right"))
    k = min(max(k, 1), len(order) - 1)
    return (scores[order[k - 1]] + scores[order[k]]) / 2


def score(text: str, model: Ranker) -> float:
    if model.weights is None:
        return ACCEPT_AT
    return reported(raw_score(text, model.weights), model)


def reported(raw: float, model: Ranker) -> float:
    return float(sigmoid(model.slope * (raw - model.cut) + np.log(ACCEPT_AT / (1 - ACCEPT_AT))))


def scored(documents: DataFrame, model: Ranker) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _judged(batch, [score(t.as_py(), model) for t in batch.column("text")])

    rows = documents.select("doc_id", F.coalesce(fold_of() == HELD_OUT, F.lit(False)).alias("held_out"),
                            text_or_empty().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(kernel, f"doc_id {kind}, {SCORED}")


def keep_documents(documents: DataFrame, model: Ranker) -> DataFrame:
    """The rows of `documents` that the ranking accepts, with all their columns."""

    @F.pandas_udf("boolean")
    def accepted(texts):
        return texts.map(lambda t: score(t, model) >= ACCEPT_AT).astype(bool)

    return filtered(documents, accepted)


def quality_ranking(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold, score all documents."""
    weights, numbers = fitted(documents, labels, fit, HELD_OUT)
    if numbers is not None:
        return scored(documents, Ranker(weights, *numbers))
    # every text is scored once: what all documents get and the cut come from the same raw scores
    held = F.coalesce(fold_of() == HELD_OUT, F.lit(False)).alias("held_out")
    raws = stored(raw_scores(documents.select("doc_id", "text", held), weights, "held_out"), "raw-scores")
    model = Ranker(weights, *cut_and_slope(learning_scores(raws.where("not held_out"), labels, HELD_OUT)))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _judged(batch, [reported(x, model) for x in batch.column("raw").to_pylist()])

    return raws.mapInArrow(kernel, f"doc_id {raws.schema['doc_id'].dataType.simpleString()}, {SCORED}")


def _judged(batch: pa.RecordBatch, s: list[float]) -> pa.RecordBatch:
    return pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()),
                            pa.array([int(x >= ACCEPT_AT) for x in s], pa.int32())],
                           names=["doc_id", "held_out", "score", "predicted"])


shipped(__name__)
