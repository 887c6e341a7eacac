"""Quality rules: base counts, and a hashed n-gram logistic regression with calibrated probabilities.

The model is fitted on all labelled rows outside the held-out fold: L2-penalised logistic loss on hashed character and
word n-grams and a few shares, in blocks of rows whose weights are averaged (`textfeat.fitted`). One fold is kept from
fitting and calibrates the probabilities (a logistic curve of all its rows' raw scores). All documents are then scored
in Arrow batches, and a document stays if it passes the base rules and its probability of good quality is at least
`KEEP_AT`.

Defined cases: null and empty texts have no words and fail the base rules; without labels of both classes there is no
model, and the base rules alone decide; repeated rows are each judged; an empty table gives no rows; other columns
are ignored (`keep_documents` passes them through). Very long texts are judged and learned from
whole; a block of more than `textfeat.SAMPLE_BYTES` of features is fitted in parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gamecast.llm.common import shipped, text_or_empty
from gamecast.llm.textfeat import (DIM, Sample, Text, descend, filtered, fitted, fold_of, learning_scores, linear_score, raw_scores,
                                    sigmoid)

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
KEEP_AT = 0.5
CALIBRATION_FOLD, HELD_OUT = 3, 2
RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "probability double, kept boolean")


@dataclass
class Model:
    """probability = sigmoid(slope * (weights . features) + offset); no weights: no model."""
    weights: np.ndarray | None = None
    slope: float = 1.0
    offset: float = 0.0


def fit(sample: Sample, penalty: float = 1e-4, steps: int = 120) -> Model:
    learn = sample.fold != CALIBRATION_FOLD
    if not sample.both(learn):
        learn = np.ones(len(sample.label), bool)
    if not sample.both(learn):
        return Model()
    # both classes weigh the same, so that the rare one is learned as well
    share = np.where(learn, 0.5 / np.where(sample.label == 1, (sample.label[learn] == 1).sum(), (sample.label[learn] == 0).sum()), 0)

    def gradient(w: np.ndarray) -> np.ndarray:
        return sample.gradient(share * (sigmoid(sample.scores(w)) - sample.label)) + penalty * w

    weights = descend(gradient, DIM, steps)
    calibrate = ~learn if sample.both(~learn) else learn
    slope, offset = platt(sample.scores(weights)[calibrate], sample.label[calibrate], sample.weight[calibrate])
    return Model(weights.astype(np.float32), slope, offset)


def platt(scores: np.ndarray, label: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Weighted logistic curve of a score by Newton steps, with Platt's softened targets (a separable fold stays finite)."""
    n1, n0 = (label == 1).sum(), (label == 0).sum()
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = weight / weight.sum()
    middle, spread = scores.mean(), scores.std() + 1e-9
    x = np.stack([(scores - middle) / spread, np.ones(len(scores))], 1)
    theta = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(x @ theta)
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (weight * (p - target)) + 1e-6 * theta)
        theta -= np.clip(step, -2, 2)
    return float(theta[0] / spread), float(theta[1] - theta[0] * middle / spread)


def learned(documents: DataFrame, labels: DataFrame) -> Model:
    """The model of all labelled rows."""
    weights, numbers = fitted(documents, labels, fit)
    if numbers is None:
        of = lambda rows: learning_scores(raw_scores(documents.where(rows), weights), labels)
        scores = of(fold_of() == CALIBRATION_FOLD)
        if scores.select("quality").distinct().count() < 2:
            scores = of(~fold_of().isin(CALIBRATION_FOLD, HELD_OUT))
        numbers = calibrated(scores)
    return Model(weights, *numbers)


def calibrated(scores: DataFrame, steps: int = 50) -> tuple[float, float]:
    """`platt` over all `scores` (raw, quality); every Newton step is one aggregation."""
    r = scores.agg(F.count("*").alias("n"), F.sum("quality").alias("n1"), F.avg("raw").alias("middle"),
                 F.stddev_pop("raw").alias("spread")).first()
    n, n1, middle, spread = r["n"], r["n1"], round(r["middle"], 9), round(r["spread"], 9) + 1e-9
    target = F.when(F.col("quality") == 1, (n1 + 1) / (n1 + 2)).otherwise(1 / (n - n1 + 2))
    x = (F.col("raw") - middle) / spread
    theta = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), x * float(theta[0]) + float(theta[1])))))
        each = scores.select(x.alias("x"), (p * (1 - p)).alias("h"), (p - target).alias("g"))
        hxx, hx, h, gx, g = (v / n for v in each.agg(F.sum(F.expr("h * x * x")), F.sum(F.expr("h * x")), F.sum("h"),
                                                     F.sum(F.expr("g * x")), F.sum("g")).first())
        step = np.linalg.solve(np.array([[hxx, hx], [hx, h]]) + 1e-6 * np.eye(2), np.array([gx, g]) + 1e-6 * theta)
        theta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    # sums in any order give the same digits
    return round(float(theta[0] / spread), 6), round(float(theta[1] - theta[0] * middle / spread), 6)


def judge(text: str, model: Model) -> tuple:
    t = Text(text)
    n, repeat, (dup, lines), symbols = len(t.words), t.repeat_words(), t.dup_lines(), t.symbols()
    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    p = 1.0
    if model.weights is not None:
        p = float(sigmoid(model.slope * linear_score(t, t.dense(repeat, dup, lines, symbols), model.weights) + model.offset))
    return n, t.word_chars(), symbols, dup, repeat, failed, p, not failed and p >= KEEP_AT


def judged(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, `RESULT` columns) of every whole text."""
    types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
    names = [c.split()[0] for c in RESULT.split(", ")]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*(judge(t.as_py(), model) for t in batch.column("text")))) or [()] * len(names)
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))],
                                  names=["doc_id", *names])

    rows = documents.select("doc_id", text_or_empty().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(kernel, f"doc_id {kind}, {RESULT}")


def keep_documents(documents: DataFrame, model: Model) -> DataFrame:
    """The rows of `documents` that stay, with all their columns."""

    @F.pandas_udf("boolean")
    def stays(texts):
        return texts.map(lambda t: judge(t, model)[-1]).astype(bool)

    return filtered(documents, stays)


def quality_rules(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled rows, judge all documents."""
    return judged(documents, learned(documents, labels))


shipped(__name__)
