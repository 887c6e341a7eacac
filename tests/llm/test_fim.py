"""Fill-in-middle against a plain loop over the units, and its exact round trip."""

import hashlib
import re

import regex
from hypothesis import given, settings, strategies as st

from gamecast.llm import fim

UNITS = regex.compile(f"({fim.LINES})*")


def brute(doc_id, text, rate=100, spm_rate=50):
    """(n, form, prefix chars, middle chars, output) by going over the lines one by one."""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digits = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[k:k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_rate:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=400, deadline=None)
@given(st.integers(-5, 10**12), st.text("ab \n<PSM>é\U0001F600\r\x85 ", max_size=40))
def test_cuts_and_round_trip(doc_id, text):
    c = fim.cut(doc_id, text, UNITS, fim.SEED, fim.RATE, fim.SPM_RATE)
    output = fim.written(text, c)
    want = brute(doc_id, text)
    middle = None if c.middle_end is None else c.middle_end - c.prefix_end
    assert (c.n, c.form, c.prefix_end, middle, output) == want
    assert fim.restore(output, c.form) == text


def test_all_rows_in_any_form(spark, odd_documents):
    extra = spark.createDataFrame([(20, "has <M> inside\nx", 1.0, "x"), (21, "line\n" * 50_000, 1.0, "x"), (22, "\n\n", 1.0, "x")],
                                  odd_documents.schema)
    docs = odd_documents.unionByName(extra)
    got = sorted(map(str, (tuple(r) for r in fim.transformed(docs).collect())))
    assert got == sorted(str((r.doc_id, *brute(r.doc_id, r.text or ""))) for r in docs.collect())
    for r in fim.restored(fim.transformed(docs)).collect():
        assert fim.restore(r.output, r.form) == r.text


def test_rates_choose_the_form(spark):
    docs = spark.range(0, 400).selectExpr("id AS doc_id", "concat('a\n', id, '\nb') AS text")
    forms = {r.form: r["count"] for r in fim.transformed(docs, rate=60, spm_rate=25).groupBy("form").count().collect()}
    assert set(forms) == {"plain", "spm", "psm"} and 100 < forms["plain"] < 220 and forms["spm"] < forms["psm"]


def test_other_units(spark):
    docs = spark.createDataFrame([(5, "one two  three")], "doc_id long, text string")
    row = fim.transformed(docs, unit=r"\S+\s*|\s+").first()
    assert row.n == 3 and fim.restore(row.output, row.form) == "one two  three"


def test_empty_table(no_documents):
    assert fim.digest(fim.transformed(no_documents)).count() == 0
