"""Fill-in-middle transformation, cut at units that a repeated capture finds.

A text is cut into units (by default lines: `[^\\n]*\\n|[^\\n]+`). One `fullmatch` of `(unit)*` by the regex library
keeps every repetition of its group, so `match.ends(1)` alone gives the number of units n and the place of every border:
no loop goes over the units. Prefix, middle and suffix end at borders that a hash of the document id picks, and are
written with sentinels as

    psm    <P> prefix <S> suffix <M> middle
    spm    <S> suffix <P> prefix <M> middle
    plain  the text as it is

`restore` gives back the exact text from output and form, because a text that holds a sentinel stays plain.

The choice is a function of seed and doc_id alone: h1 to h4 are the first four groups of 8 digits of the hex SHA-256 of
`seed:doc_id`. Prefix and middle end after the smaller and the larger of h1 % (n + 1) and h2 % (n + 1) units; h3 % 100 below
`rate` transforms, h4 % 100 below `spm_rate` writes spm.

Defined cases: a null text is empty, and an empty text is plain (n = 0); a null doc_id is hashed as an empty decimal;
repeated rows are each transformed, alike; ties of h1 and h2 give an empty middle; a very long text is matched whole
(the captures take some 200 bytes a unit); an empty table gives no rows; other columns, also of clashing names, are
ignored by `transformed`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from gamecast.llm.common import shipped, text_or_empty

LINES = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM_RATE = 7, 100, 50
RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"


class Cut(NamedTuple):
    """The units of a text, and where prefix and middle end (None: plain)."""
    n: int
    form: str
    prefix_end: int | None
    middle_end: int | None


def choices(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digits[k:k + 8], 16) for k in range(0, 32, 8))


def cut(doc_id: int | None, text: str, units: regex.Pattern, seed: int, rate: int, spm_rate: int) -> Cut:
    """`units`: the compiled `(unit)*`, which has to match every text whole."""
    ends = units.fullmatch(text).ends(1)
    n = len(ends)
    h1, h2, h3, h4 = choices(doc_id, seed)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= rate:
        return Cut(n, "plain", None, None)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    border = [ends[k - 1] if k else 0 for k in (first, second)]
    return Cut(n, "spm" if h4 % 100 < spm_rate else "psm", *border)


def written(text: str, c: Cut) -> str:
    if c.form == "plain":
        return text
    prefix, middle, suffix = text[:c.prefix_end], text[c.prefix_end:c.middle_end], text[c.middle_end:]
    if c.form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The exact text of an output: its parts hold no sentinel, so each sentinel stands where it was written."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    head, middle = output[len(first):].split(MIDDLE)
    one, two = head.split(second)
    return one + middle + two if form == "psm" else two + middle + one


def transformed(documents: DataFrame, unit: str = LINES, seed: int = SEED, rate: int = RATE,
                spm_rate: int = SPM_RATE) -> DataFrame:
    """(doc_id, `RESULT` columns): every whole text in its form. `unit`: a pattern whose repetition matches any text."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(f"({unit})*")
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for at in range(0, len(ids), 256):       # few at a time: an output is as long as its text
                part = [t.as_py() for t in texts.slice(at, 256)]
                cuts = [cut(d, t, units, seed, rate, spm_rate) for d, t in zip(ids.slice(at, 256).to_pylist(), part)]
                lengths = [(c.prefix_end, None if c.middle_end is None else c.middle_end - c.prefix_end) for c in cuts]
                yield pa.record_batch(
                    [ids.slice(at, 256), pa.array([c.n for c in cuts], pa.int64()), pa.array([c.form for c in cuts], pa.string()),
                     pa.array([p for p, _ in lengths], pa.int64()), pa.array([m for _, m in lengths], pa.int64()),
                     pa.array([written(t, c) for t, c in zip(part, cuts)], pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = documents.select("doc_id", text_or_empty().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(kernel, f"doc_id {kind}, {RESULT}")


def restored(outputs: DataFrame) -> DataFrame:
    """`outputs` with a further column `text`, rebuilt from `output` and `form`."""

    @F.pandas_udf("string")
    def rebuilt(output, form):
        return output.combine(form, restore)

    return outputs.withColumn("text", rebuilt("output", "form"))


def digest(outputs: DataFrame) -> DataFrame:
    """The numbers of `transformed`, and digests of output and rebuilt text."""
    return restored(outputs).select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                                    F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"))


shipped(__name__)
