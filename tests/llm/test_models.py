"""The two learned operators against plain versions of their features, losses and fits."""

import math
import re
import zlib

import numpy as np
import pytest

from gamecast.llm import pairwise, rules, textfeat as tf

TEXTS = ["", "one", "Ab ab ab ab ab. 12 #$ é\n\nab\nab\n x", "the cat, the dog. the cat, the dog.\nÜber 日本 \U0001F600 words", "aaaa bbbb cccc dddd " * 9,
         "A B C D E F G", "line\nline\nline one two three one two three", "zz | yy | %%% && <> zz"]
LABELS = [0, 0, 0, 1, 0, 1, 1, 0]


def naive_features(text):
    """The feature vector by loops over the text, arithmetic in whole numbers modulo 2^32."""
    m32 = (1 << 32) - 1
    x = np.zeros(tf.DIM)
    chars, words = [ord(c) for c in text], re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = [zlib.crc32(w.encode()) for w in words]
    c3 = [(a * 73856093 + b * 19349663 + c * 83492791) & m32 for a, b, c in zip(chars, chars[1:], chars[2:])]
    groups = [c3, [(h * 31 + c * 50331653) & m32 for h, c in zip(c3, chars[3:])], hashes,
              [((a * 16777619) & m32) ^ ((b * 2246822519) & m32) for a, b in zip(hashes, hashes[1:])]]
    for k, group in enumerate(groups):
        for h in group:
            x[(k << tf.BITS) + (((h * 2654435761) & m32) >> (32 - tf.BITS))] += tf.SCALE / len(group)
    windows = list(zip(words, words[1:], words[2:]))
    covered = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    n, size = max(1, len(words)), max(1, len(text))
    raw = text.encode()
    x[-len(tf.DENSE):] = [tf.DENSE_SCALE * v for v in (
        len(covered) / n, sum(a == b for a, b in zip(words, words[1:])) / n, (len(lines) - len(set(lines))) / max(1, len(lines)), len(set(words)) / n,
        min(1.0, 10 * sum(c in "#*$%&|<>" for c in text) / size), sum(65 <= b < 91 for b in raw) / size,
        sum(48 <= b < 58 for b in raw) / size, sum(c in ".," for c in text) / n)]
    return x


def sample():
    rows = []
    for k, (text, label) in enumerate(zip(TEXTS, LABELS)):
        at, value = tf.sparse_row(text)
        rows.append({"doc_id": k, "quality": label, "fold": k % 2 * 3, "at": at.astype("<i4").tobytes(), "value": value.astype("<f4").tobytes()})
    return tf.Sample(rows, {0: 50, 1: 30})


def test_features_are_the_naive_ones():
    for text in TEXTS:
        at, value = tf.sparse_row(text)
        got = np.zeros(tf.DIM)
        got[at] = value
        assert np.allclose(got, naive_features(text), atol=1e-4)


def adam(gradient, steps):
    w, m, v = np.zeros(tf.DIM), 0, 0
    for k in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.1 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
    return w


def test_ranking_is_the_loss_over_pairs():
    """Weights, cut and scores of a dense fit that adds up the logistic loss pair by pair."""
    x, y = np.array([naive_features(t) for t in TEXTS]), np.array(LABELS)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    rng = np.random.default_rng(7)
    pairs = list(zip(rng.choice(good, 15), rng.choice(bad, 15)))

    def gradient(w):
        g = 1e-4 * w
        for a, b in pairs:
            d = x[a] - x[b]
            g = g - d / (1 + math.exp(d @ w)) / len(pairs)
        return g
    w = adam(gradient, 20)
    model = pairwise.fit(sample(), pairs=15, steps=20)
    assert np.allclose(model.weights, w, atol=2e-3)
    scores = x @ w
    weight = np.where(y == 1, 30 / 3, 50 / 5)
    order = np.argsort(scores)
    below = [k for k in range(1, 8) if weight[order[:k]].sum() <= 50 / 80 * weight.sum() * (1 + 1e-9)][-1]
    cut = (scores[order[below - 1]] + scores[order[below]]) / 2
    assert model.cut == pytest.approx(cut, abs=0.05)
    for text, s in zip(TEXTS, scores):
        want = 1 / (1 + math.exp(-(model.slope * (s - cut) + math.log(0.7 / 0.3))))
        assert pairwise.score(text, model) == pytest.approx(want, abs=0.02)
        assert (pairwise.score(text, model) >= 0.7) == (s >= cut)


def test_rules_verdict_is_the_calibrated_model():
    """Weights of a dense class-weighted fit; the verdict is base rules and calibrated probability."""
    x, y = np.array([naive_features(t) for t in TEXTS]), np.array(LABELS)
    learn = np.arange(len(y)) % 2 == 0                        # fold 3 calibrates
    share = np.where(y == 1, 0.5 / y[learn].sum(), 0.5 / (1 - y[learn]).sum())

    def gradient(w):
        g = 1e-4 * w
        for k in np.flatnonzero(learn):
            g = g + share[k] * (1 / (1 + math.exp(-(x[k] @ w))) - y[k]) * x[k]
        return g
    w = adam(gradient, 20)
    model = rules.fit(sample(), steps=20)
    assert np.allclose(model.weights, w, atol=2e-3)
    for text in [*TEXTS, " ".join(f"w{k} ok" for k in range(60)), "same old words " * 40]:
        n, _, _, _, repeat, failed, p, kept = rules.judge(text, model)
        want = 1 / (1 + math.exp(-(model.slope * float(naive_features(text) @ model.weights) + model.offset)))
        assert p == pytest.approx(want, abs=1e-3)
        assert failed == (n < 50 or 100 * repeat > 50 * n) and kept == (not failed and p >= 0.5)


def test_calibration_minimises_the_weighted_loss():
    rng = np.random.default_rng(5)
    scores, label = rng.normal(size=400), (rng.random(400) < 0.4).astype(int)
    scores = scores + label
    weight = rng.random(400) + 0.5
    slope, offset = rules.platt(scores, label, weight)
    n1, n0 = label.sum(), 400 - label.sum()
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))

    def loss(a, b):
        z = a * scores + b
        return (weight * (np.logaddexp(0, z) - target * z)).sum()
    best = loss(slope, offset)
    assert all(loss(slope + da, offset + db) >= best - 1e-6 for da in (-0.05, 0, 0.05) for db in (-0.05, 0, 0.05))
