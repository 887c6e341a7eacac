"""SimHash classes, components, line classes and nearest neighbours against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gamecast.llm import ann, linededup, simhash
from gamecast.llm.components import components


def classes(nodes, linked):
    """Partition of `nodes` by the pairs for which `linked` holds."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                root[find(a)] = find(b)
    out = defaultdict(set)
    for n in nodes:
        out[find(n)].add(n)
    return {frozenset(s) for s in out.values()}


def test_components_of_chains_stars_and_noise(spark):
    rng = random.Random(1)
    pairs = [(k, k + 1) for k in range(100, 160)] + [(0, k) for k in range(1, 30)] + [(200, 300), (300, 200), (5, 5)]
    pairs += [(rng.randrange(400, 480), rng.randrange(400, 480)) for _ in range(60)]
    df = spark.createDataFrame(pairs + [(None, 3), (7, None)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    nodes = sorted({n for a, b in pairs if a != b for n in (a, b)})
    links = {frozenset(p) for p in pairs}
    want = {n: min(c) for c in classes(nodes, lambda a, b: frozenset((a, b)) in links) for n in c}
    assert got == want
    assert components(df.limit(0)).count() == 0


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = low.encode().split()
    shingles = [b" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_is_spark_xxhash(spark, odd_documents):
    for text in ("", "A b", "one two THREE four five six", "é É a b c"):
        assert simhash.fingerprint(text.encode()) == brute_print(text)
    h = spark.sql("select xxhash64('a b c d') h").first().h
    assert simhash.fingerprint(b"a B c d") == h & (1 << 64) - 1


def near_bits(seed):
    """Fingerprints with clusters, chains, and one dense family."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    out = set(base.tolist())
    for _ in range(700):
        x = int(base[rng.integers(30)])
        for _ in range(rng.integers(0, 7)):
            x ^= 1 << int(rng.integers(64))
        out.add(x)
    for _ in range(250):
        x = int(base[40])
        for j in rng.integers(0, 10, rng.integers(0, 8)):
            x ^= 1 << int(j) * 6
        out.add(x)
    return sorted(out)


def test_links_connect_what_is_within_four_bits(spark):
    bits = near_bits(2)
    want = {c for c in classes(bits, lambda a, b: (a ^ b).bit_count() <= 4) if len(c) > 1}
    signed = np.array(bits, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(b,) for b in signed], "bits long")
    for run_rows in (simhash.RUN_ROWS, 20):      # the second sends every dense run by its midpoints
        got = defaultdict(set)
        for r in components(simhash.links(df, run_rows)).collect():
            got[r.component].add(r.node & (1 << 64) - 1)
        assert {frozenset(s) for s in got.values()} == want


def test_near_duplicate_documents(spark, odd_documents, no_documents):
    rng = random.Random(4)
    rows = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    base = " ".join(rng.choice("alpha beta gamma delta epsilon".split()) + str(rng.randrange(50)) for _ in range(200))
    for k in range(40):
        words = base.split()
        words[rng.randrange(200)] = f"edit{k}"
        rows.append((100 + k, " ".join(words)))
    rows += [(500, base.upper()), (501, base), (501, base)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_duplicates(df.withColumn("component_id", F.lit("clash"))).collect()
    prints = {t: brute_print(t or "") for _, t in rows}
    groups = classes(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {p: min((d for d, t in rows if prints[t] in g and d is not None), default=None) for g in groups for p in g}
    assert sorted(map(str, map(tuple, got))) == sorted(str((d, f"{prints[t]:016x}", least[prints[t]])) for d, t in rows)
    wide = df.withColumn("row", F.lit(1)).withColumn("Doc", F.lit("x"))
    kept = simhash.keep_first(wide)
    assert kept.columns == wide.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({v for v in least.values() if v is not None})
    assert simhash.near_duplicates(no_documents).count() == simhash.keep_first(no_documents).count() == 0


def shingles(line):
    code = line.encode("utf-16-be")
    return {code[2 * k:2 * k + 16] for k in range(max(1, len(code) // 2 - 7))}


def similar(a, b):
    both = len(shingles(a) & shingles(b))
    return both >= 0.8 * (len(shingles(a)) + len(shingles(b)) - both)


def line_rows():
    rng = random.Random(3)
    lines = [" ".join(f"{rng.choice('alpha beta gamma delta'.split())}{rng.randrange(99)}" for _ in range(rng.randint(2, 20)))
             for _ in range(40)]

    def edited(line):
        out = list(line)
        for _ in range(rng.randint(0, 2)):
            out[rng.randrange(len(out))] = rng.choice("xyzé\U0001F600")
        return "".join(out)

    rows = [(k, "\n".join(edited(rng.choice(lines)) for _ in range(rng.randint(0, 5)))) for k in range(200)]
    return rows + [(300, None), (301, ""), (302, "\n \n"), (None, lines[0]), (303, rows[5][1]), (5, rows[5][1]),
                   (5, lines[3] + "\n" + lines[4]), (304, "  " + lines[1].upper() + " \nkept \n\n"), (305, "x\nX\ny")]


def test_line_dedup_keeps_one_line_a_class(spark, no_documents):
    rows = line_rows()
    wide = spark.createDataFrame([(d, t, len(t or ""), "k") for d, t in rows], "doc_id long, text string, n_chars long, `key` string")
    out = linededup.dedup_lines(wide)
    assert out.columns == wide.columns
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(rows) and all(n == len(t or "") for d, t, n, _ in got if d is not None)
    occurrences = [(d, t, k, line.strip(" ").lower()) for d, t in sorted({(d, t) for d, t in rows if d is not None and t is not None})
                   for k, line in enumerate(t.split("\n")) if line.strip(" ")]
    groups = classes(sorted({o[3] for o in occurrences}), similar)
    of = {line: g for g in groups for line in g}
    left = defaultdict(int)
    for d, t in {(d, t) for d, t, *_ in got if d is not None}:
        for line in (t or "").split("\n"):
            if line.strip(" "):
                left[of[line.strip(" ").lower()]] += 1
    first = {g: min(d for d, _, _, line in occurrences if line in g) for g in groups}
    assert left == {g: 1 for g in groups}
    texts = defaultdict(list)
    for d, t, *_ in got:
        texts[d].append(t)
    for g, d in first.items():      # the one that stays is in the first document
        assert any(line.strip(" ").lower() in g for t in texts[d] for line in t.split("\n"))
    assert texts[300] == [None] and texts[301] == [""] and texts[None] == [rows[-6][1]] and texts[302] == ["\n \n"]
    assert linededup.dedup_lines(no_documents).count() == 0
    digest = {r.doc_id: r for r in linededup.digest(out).collect()}
    assert digest[302].kept_sha256 == hashlib.sha256(b"\n \n").hexdigest() and digest[301].n_kept == 0


@pytest.mark.parametrize("few, block", [(linededup.FEW, linededup.BLOCK), (8, 20)])
def test_all_pairs_of_a_bucket_are_met(spark, monkeypatch, few, block):
    """Three hundred template lines below the threshold in one bucket, and a few near copies far apart in it."""
    monkeypatch.setattr(linededup, "FEW", few)
    monkeypatch.setattr(linededup, "BLOCK", block)
    monkeypatch.setattr(linededup, "band_rows", lambda signed: signed.select(F.lit(0).alias("key"), "h"))
    rng = random.Random(6)
    lines = ["copyright notice of the issue " + "".join(rng.choice("abcdefghij ") for _ in range(50)) + "." for _ in range(300)]
    lines += [line[:-1] + c for line in lines[:6] for c in "!?;"] + ["one long common line of this group, number " + "x" * k for k in range(30)]
    df = linededup.lines_of(spark.createDataFrame([(k, line) for k, line in enumerate(lines)], "doc_id long, text string"))
    of = {r.h: r.line for r in df.collect()}
    got = defaultdict(set)
    for r in linededup.line_classes(df).collect():
        got[r.component].add(of[r.node])
    want = {g for g in classes(sorted(set(of.values())), similar) if len(g) > 1}
    assert len(want) >= 7 and {frozenset(g) for g in got.values()} == want


def test_verification_is_exact(spark):
    body = "the quick brown fox jumps over the lazy dog and runs into the deep dark wood "
    texts = {1: body * 3, 2: body * 2 + "something else entirely, it is another matter of fact " * 2,
             3: body * 2 + "something else entirely, it is another matter of fact " * 2 + "!"}
    assert similar(texts[2], texts[3])
    df = linededup.coded(spark.createDataFrame(list(texts.items()), "h long, line string"))
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a long, b long")
    got = {(r.a, r.b) for r in linededup.verified(pairs, df).collect()}
    assert got == {(a, b) for a, b in ((1, 2), (1, 3), (2, 3)) if similar(texts[a], texts[b])}


def test_signatures_find_short_similar_lines(spark):
    """Pairs of nine shingles each, eight of them in both: similarity 0.8, the least that counts."""
    rng = random.Random(8)
    heads = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(15)) for _ in range(4000)]
    df = spark.createDataFrame([(k, head + end) for k, head in enumerate(heads) for end in "01"], "pair long, line string")
    assert similar(heads[0] + "0", heads[0] + "1")
    signed = linededup.signatures(df.select(F.xxhash64("line").alias("h"), "line")).collect()
    of = {r.h: r[1:] for r in signed}
    pairs = defaultdict(list)
    for r in df.select("pair", F.xxhash64("line").alias("h")).collect():
        pairs[r.pair].append(of[r.h])
    found = 0
    for x, y in pairs.values():
        same = [a == b for a, b in zip(x, y)]
        found += any(all(same[j] for j in band) for band in linededup.BANDS) and sum(same) >= linededup.AGREE
    assert found / len(heads) >= 0.98      # 0.99 by independent hashes; exclusive or with masks found 0.9


def test_bands_and_native_plan(spark):
    assert all(len(set(b)) == linededup.ROWS for b in linededup.BANDS) and len(set(map(tuple, linededup.BANDS))) == 12
    df = spark.createDataFrame([(1, "a line of text\nand more")], "doc_id long, text string")
    plan = linededup.band_rows(linededup.signatures(linededup.lines_of(df)))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "MapInArrow"))


def unit(x):
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def brute_nearest(rows, k=5):
    rows = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, x = np.array([i for i, _ in rows]), unit(np.array([v for _, v in rows], np.float64))
    out = {}
    for q, v in zip(ids, x):
        if q % 50 == 0:
            s = x @ v
            best = sorted({(-round(float(c), 12), int(i)) for i, c in zip(ids, s) if i != q})[:k]
            out[int(q)] = [(i, -c) for c, i in best]
    return out


def run_search(spark, rows):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int")
    out = defaultdict(list)
    for r in sorted(ann.search(df, F.col("vec_id") % 50 == 0).collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_search_of_few_vectors_is_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.integers(-3, 4, 8).astype(float).tolist()) for k in range(120)]
    rows[10] = (10, [0.0] * 8)
    rows += [(500, None), (501, [1.0, None] + [0.0] * 6), (502, [float("nan")] + [1.0] * 7), (503, [float("inf")] * 8),
             (None, [1.0] * 8), (600, rows[0][1]), (601, rows[0][1]), (602, rows[0][1])]
    got, want = run_search(spark, rows), brute_nearest(rows)
    assert {q: [i for i, _ in a] for q, a in got.items()} == {q: [i for i, _ in a] for q, a in want.items()}
    assert all(abs(s - t) < 1e-12 for q in want for (_, s), (_, t) in zip(got[q], want[q]))
    assert run_search(spark, rows[:3]) and not run_search(spark, [(500, None)])
    (only,) = run_search(spark, [(0, [1.0] * 8), (7, [2.0] * 8)])[0]
    assert only[0] == 7 and abs(only[1] - 1) < 1e-15


def test_rows_of_one_id_are_one_candidate(spark):
    """Every row up to six times, some ids with unlike vectors: bounds and cuts to k must count ids, not rows."""
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(8).astype(np.float32).astype(float).tolist()) for k in range(300)]
    near = [(1000 + k, (np.array(rows[50 * k][1]) * 2).tolist()) for k in range(6)]
    unlike = [(k, rng.standard_normal(8).astype(np.float32).astype(float).tolist()) for k in range(1, 40) if k % 50]
    got = run_search(spark, rows * 2 + near * 6 + unlike + rows[:30] * 4)
    x = unit(np.array([v for _, v in rows + near + unlike]))
    for q in range(0, 300, 50):
        scores = defaultdict(lambda: -2.0)
        for (i, _), s in zip(rows + near + unlike, x @ x[q]):
            if i != q:
                scores[i] = max(scores[i], float(s))
        want = sorted(scores, key=lambda i: (-scores[i], i))[:5]
        assert [i for i, _ in got[q]] == want and all(abs(s - scores[i]) < 1e-9 for i, s in got[q])


def test_recall_and_salted_lists(spark, monkeypatch):
    """Random vectors, the hardest case, with one vector a third of all rows; lists and queries split over many rows."""
    monkeypatch.setattr(ann, "BOUND_ROWS", 256)
    monkeypatch.setattr(ann, "GROUP_ROWS", 40)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((6000, 24))
    x[::3] = x[0]
    rows = list(enumerate(x.tolist()))
    got = run_search(spark, rows)
    x = np.asarray(x, np.float32).astype(np.float64)
    want = brute_nearest(list(enumerate(x.tolist())))
    assert set(got) == set(want) and all(len(a) == 5 for a in got.values())
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want])
    assert recall >= 0.9
    hot = [q for q in want if q % 3 == 0]
    assert all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in hot)


def test_cosines_of_large_and_tiny_vectors(spark):
    rows = [(0, [1e200, 1e200, 0.0]), (1, [1e200, 0.0, 0.0]), (2, [1e-200, 1e-200, 0.0]), (3, [1.0, 0.5, 0.25]), (4, [0.0, 5e-324, 0.0]),
            (50, [1.0, 1.0, 1.0]), (51, [1.0, 2.0]), (52, [0.0, 0.0, 0.0]), (53, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in ann.search(df, F.col("vec_id") % 50 == 0).collect()}
    unit = {i: np.array(v) / np.abs(v).max() for i, v in rows[:6]}
    want = {(q, i): float(unit[q] @ unit[i] / np.linalg.norm(unit[q]) / np.linalg.norm(unit[i])) for q in (0, 50) for i in unit if i != q}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_scaling_leaves_ordinary_cosines_as_they_are():
    x, y = np.random.default_rng(1).standard_normal((2, 500, 16))
    plain = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))
    assert np.array_equal(ann.cosines(x, y), plain)


def test_search_over_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert ann.search(df, F.col("vec_id") % 50 == 0).collect() == []


def test_classes_after_further_links_are_those_of_all_links(spark):
    rng = random.Random(3)
    pairs = lambda n: [(rng.randrange(80), rng.randrange(80)) for _ in range(n)]
    first, more = pairs(30), pairs(25)
    df = lambda rows: spark.createDataFrame(rows, "a long, b long")
    found = components(df(first))
    got = {r.node: r.component for r in linededup.joined(found, df([p for p in more if p[0] != p[1]])).collect()}
    want = {r.node: r.component for r in components(df(first + more)).collect()}
    assert got == want


def test_sketches_lose_no_similar_pair(spark):
    """Lines with up to half of their characters changed, some of them long or full of repeats."""
    rng = random.Random(9)
    lines = set()
    for size in (1, 7, 9, 40, 200, 900, 5000):
        for base in ("".join(rng.choice("abcdefgh é\U0001F600") for _ in range(size)), "ab " * size):
            lines.add(base)
            for changes in (1, 2, size // 300 + 1, size // 150 + 1, size // 90 + 1, size // 40 + 1, size // 4 + 1):
                out = list(base)
                for _ in range(changes):
                    out[rng.randrange(len(out))] = rng.choice("xyz")
                lines.add("".join(out))
    of = dict(enumerate(sorted(lines)))
    df = spark.createDataFrame(list(of.items()), "h long, line string")
    signed = linededup.signatures(df).join(linededup.sketches(linededup.coded(df)), "h")
    pairs = [(a, b) for a in of for b in of if a < b and abs(len(of[a]) - len(of[b])) < 5]
    kept = {(r.a, r.b) for r in linededup.likely(spark.createDataFrame(pairs, "a long, b long"), signed).collect()}
    want = {(a, b) for a, b in pairs if similar(of[a], of[b])}
    assert len(want) > 12 and want <= kept and len(kept) < len(pairs) / 2


def test_lines_that_only_look_alike_are_not_verified_pair_by_pair(spark, monkeypatch):
    """A bucket of notices with one long body and ends of their own, and three near copies of some."""
    rng = random.Random(10)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    body = word(180)
    lines = [body + word(100) for _ in range(120)]
    lines += [line[:-1] + c for line in lines[:10] for c in "!?;"]
    tried = []
    exact = linededup.verified

    def counted(pairs, texts):
        tried.append(pairs.count())
        return exact(pairs, texts)

    monkeypatch.setattr(linededup, "verified", counted)
    monkeypatch.setattr(linededup, "band_rows", lambda signed: signed.select(F.lit(0).alias("key"), "h"))
    df = linededup.lines_of(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    of = {r.h: r.line for r in df.collect()}
    got = defaultdict(set)
    for r in linededup.line_classes(df).collect():
        got[r.component].add(of[r.node])
    want = {g for g in classes(sorted(set(of.values())), similar) if len(g) > 1}
    assert len(want) == 10 and {frozenset(g) for g in got.values()} == want
    assert sum(tried) < len(lines)        # all of the 11,000 pairs agree in some places of their signatures
