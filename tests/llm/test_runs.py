"""Lyndon arrays and periodic runs against their definitions."""

import hashlib
import os
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from gamecast.llm import lyndonruns, queries

SF = "/root/testdata/sf0.001"


def brute_lyndon(s):
    def is_lyndon(w):
        return all(w < w[k:] for k in range(1, len(w)))
    return [max(j - i for j in range(i + 1, len(s) + 1) if is_lyndon(s[i:j])) for i in range(len(s))]


def brute_runs(s, least=6, times=4):
    out = []
    for q in range(1, len(s) // times + 1):
        i = 0
        while i + q < len(s):
            if s[i] != s[i + q]:
                i += 1
                continue
            begin = i
            while i + q < len(s) and s[i] == s[i + q]:
                i += 1
            length = i + q - begin
            if length >= max(least, times * q) and not any(
                    s[begin:begin + length - d] == s[begin + d:begin + length] for d in range(1, q)):
                out.append((begin, length, q))
    return sorted(out)


def ranks(s):
    return np.unique(np.array(s, int), return_inverse=True)[1].tolist(), len(set(s))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=16))
def test_lyndon_array_under_both_orders(s):
    rank, symbols = ranks(s)
    assert lyndonruns.lyndon_lengths(rank, symbols) == brute_lyndon(rank)
    turned = [symbols - 1 - r for r in rank]
    assert lyndonruns.lyndon_lengths(turned, symbols) == brute_lyndon(turned)


pieces = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 9)), max_size=6)


@settings(max_examples=800, deadline=None)
@given(pieces)
def test_runs_of_texts_with_repeats(parts):
    s = [x for unit, times in parts for x in unit * times]
    words = [b"w%d" % x for x in s]
    assert [tuple(r) for r in lyndonruns.word_runs(words)] == brute_runs(s)
    assert [tuple(r) for r in lyndonruns.find_runs(np.array(s, int))] == brute_runs(s)
    assert [tuple(r) for r in lyndonruns.find_runs(np.array(s, int), 2, 3)] == brute_runs(s, 2, 3)


def test_long_inputs_of_every_kind():
    random = np.random.default_rng(3)
    thue = [bin(k).count("1") % 2 for k in range(1500)]
    for s in ([0] * 1500, [k % 277 for k in range(2500)], thue, random.integers(0, 2, 1500).tolist(),
              random.integers(0, 50, 500).tolist() * 5):
        assert [tuple(r) for r in lyndonruns.word_runs([b"%d" % x for x in s])] == brute_runs(s)


def test_ties_go_to_the_smallest_start():
    R = lyndonruns.Run
    assert lyndonruns.greatest([R(9, 8, 2), R(3, 4, 1), R(20, 12, 3)]) == R(3, 4, 1)
    assert lyndonruns.greatest([R(3, 12, 3), R(3, 8, 2)]) == R(3, 8, 2)
    assert lyndonruns.greatest([]) is None


def brute_row(doc_id, words):
    runs = brute_runs(words)
    gone = {k for b, n, q in runs for k in range(b + q, b + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    lines = "".join(f"{b},{n},{q}\n" for b, n, q in runs)
    left = " ".join(w for k, w in enumerate(words) if k not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def tiled(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_query_on_all_documents(spark):
    want = [brute_row(r.doc_id, tiled(r.doc_id, re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))
            for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, SF).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert sum(r[1] > 0 for r in got) > 10


def test_odd_documents(spark, odd_documents, no_documents):
    more = spark.createDataFrame([(30, "a b " * 40_000, 1.0, "x"), (31, "z z z z z z", 1.0, "x"), (32, "z z z z z", 1.0, "x")],
                                 odd_documents.schema)
    rows = lyndonruns.periodic_runs(odd_documents.unionByName(more)).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == odd_documents.count() + 3
    assert by_id[30].runs == [(0, 80_000, 2)] and by_id[30].collapsed == "a b"
    assert by_id[31].n_runs == 1 and by_id[31].exponent_milli == 6000 and by_id[31].collapsed == "z"
    assert by_id[32].n_runs == 0 and by_id[32].start is None and by_id[32].collapsed == "z z z z z"
    assert by_id[2].n_words == 0 and by_id[2].collapsed == ""
    assert by_id[5].runs == [(0, 60_000, 1954)]
    assert lyndonruns.periodic_runs(no_documents).count() == 0
