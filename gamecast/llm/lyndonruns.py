"""Periodic runs of words: Lyndon arrays by Baier grouping, Lyndon roots extended through LCE.

A run is a stretch of consecutive words with smallest period q, at least max(`LEAST`, `TIMES` * q) words long, that no
neighbouring word extends keeping that period. Every run has a Lyndon root: a word (of words) that is the longest
Lyndon word at its place under one of two orders, an order of the alphabet or its reverse. So

1. `lyndon_lengths` groups the suffixes as phase one of Baier's suffix sorting does. Groups are taken from the highest
   to the lowest; a group's members are absorbed by the nearest place on their left that is still open, whose context
   they prolong, and the absorbing places move to a new group next to their old one, further up the more members they
   took. When a place is absorbed its context is the longest Lyndon word there: its length is the Lyndon array, without
   a second phase. It is done once for each order.
2. `find_runs` takes a place and its Lyndon length as a candidate (start, period). If the next period reads alike, the
   longest common extensions (LCE) to the right and to the left give the whole run. A candidate inside a run that is
   already known under the same period is not extended again.

Before that, `stretches` cuts off what can't be in a run, without losing one: a run of at least 4 periods and 6 words
holds each of its 3-word windows three times or more, so words between windows that occur less often in the text (then
in the stretch) separate runs. A neighbour that would prolong a run stands in such a window as well, so a stretch's runs
are the text's runs.

Words are `[^\\x20\\x09-\\x0D]+`. A text's words are numbered by a dictionary of its own; memory grows with one text.

Defined cases: null and empty texts have no words and no runs; ties of the greatest exponent go to the smallest start,
then the smallest period; repeated rows are each searched; very long texts are searched whole, in time that grows with
the text's length (LCE compares bytes in doubling steps); an empty table gives no rows; other columns, also of
clashing names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cmp_to_key
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gamecast.llm.common import shipped, text_or_empty

LEAST, TIMES = 6, 4
RESULT = ("n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs array<struct<start:long,length:long,period:long>>, collapsed string")
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class Run(NamedTuple):
    start: int
    length: int
    period: int


def lyndon_lengths(rank: list[int], symbols: int) -> list[int]:
    """Length of the longest Lyndon word at each place of `rank` (values 0 .. `symbols` - 1, all of which occur).

    Open places and their contexts tile the text: the place after p's context is the next open one. `down` lists the
    groups from the highest to the lowest.
    """
    n = len(rank)
    length, left = [1] * n, list(range(-1, n - 1))
    group = rank[:]
    members: list[list[int]] = [[] for _ in range(symbols)]
    for place, r in enumerate(rank):
        members[r].append(place)
    down, up = list(range(-1, symbols - 1)), list(range(1, symbols)) + [-1]
    top = symbols - 1
    while top >= 0:
        took: dict[int, list[int]] = {}
        size = 0
        for first in members[top]:
            if group[first] != top:                       # moved on to a higher group of its own
                continue
            open_left = left[first]
            if open_left >= 0 and group[open_left] == top:
                continue                                  # not the first of its row of members
            size = size or length[first]
            at, k = first, 0
            while at < n and group[at] == top:
                at += size
                k += 1
            if at < n:
                left[at] = open_left
            if open_left >= 0:
                length[open_left] += at - first
                took.setdefault(k, []).append(open_left)
        members[top] = []
        below = down[top]
        if below >= 0:
            up[below] = -1
        # Those that took more stand higher: their new groups are put next to the old ones first.
        for k in sorted(took, reverse=True):
            split: dict[int, int] = {}
            for place in took[k]:
                old = group[place]
                new = split.get(old)
                if new is None:
                    new = split[old] = len(members)
                    members.append([])
                    over = up[old]
                    down.append(old)
                    up.append(over)
                    up[old] = new
                    if over >= 0:
                        down[over] = new
                    else:
                        below = new
                members[new].append(place)
                group[place] = new
        top = below
    return length


def _equal(data: bytes, a: int, b: int, n: int) -> bool:
    return data[4 * a:4 * (a + n)] == data[4 * b:4 * (b + n)]


def common_right(data: bytes, a: int, b: int, n: int) -> int:
    """LCE of the suffixes at a < b of a text of n words (4 bytes each)."""
    k, step, most = 0, 4, n - b
    while k < most and _equal(data, a + k, b + k, min(step, most - k)):
        k += min(step, most - k)
        step *= 2
    most = min(step, most - k)                            # the difference lies within so many words
    while most > 1:
        half = most // 2
        if _equal(data, a + k, b + k, half):
            k, most = k + half, most - half
        else:
            most = half
    return k


def common_left(data: bytes, a: int, b: int) -> int:
    """Longest common ending of the prefixes before a < b."""
    k, step, most = 0, 4, a
    while k < most and _equal(data, a - k - min(step, most - k), b - k - min(step, most - k), min(step, most - k)):
        k += min(step, most - k)
        step *= 2
    most = min(step, most - k)
    while most > 1:
        half = most // 2
        if _equal(data, a - k - half, b - k - half, half):
            k, most = k + half, most - half
        else:
            most = half
    return k


def find_runs(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[Run]:
    """The runs of a sequence, by start, then period (`times` >= 3: then one of its roots is followed by a whole one)."""
    n = len(ids)
    if n < least:
        return []
    values, rank = np.unique(ids, return_inverse=True)
    data = rank.astype("<i4").tobytes()
    found: dict[int, list[tuple[int, int]]] = {}          # period -> [start, end) of its runs, ends ascending
    for order in (rank, len(values) - 1 - rank):
        periods = np.array(lyndon_lengths(order.tolist(), len(values)), np.int64)
        places = np.flatnonzero(np.arange(n) + 2 * periods <= n)
        places = places[rank[places] == rank[places + periods[places]]]
        last: dict[int, int] = {}                         # period -> end of its last known run under this order
        for at, period in zip(places.tolist(), periods[places].tolist()):
            if last.get(period, 0) >= at + 2 * period:
                continue
            right = common_right(data, at, at + period, n)
            if right < period:
                continue
            begin, end = at - common_left(data, at, at + period), at + period + right
            last[period] = end
            if end - begin >= max(least, times * period):
                found.setdefault(period, []).append((begin, end))
    return sorted(Run(b, e - b, q) for q, runs in found.items() for b, e in set(runs))


def stretches(ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts [begin, end) of a sequence that hold every run of at least 4 periods and 6 words, and its neighbours."""
    todo = [(0, len(ids))]
    while todo:
        begin, end = todo.pop()
        if end - begin < LEAST:
            continue
        part = ids[begin:end].astype(np.uint64)
        windows = (part[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ part[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
                   ^ part[2:] * np.uint64(0x165667B19E3779F9))       # equal windows collide, which is the safe side
        _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
        often = np.concatenate([[False], count[which] >= 3, [False]])
        if often[1:-1].all():
            yield begin, end
            continue
        border = np.flatnonzero(often[1:] != often[:-1])
        todo.extend((begin + a, begin + b + 2) for a, b in zip(border[::2].tolist(), border[1::2].tolist()))


def word_runs(words: list[bytes]) -> list[Run]:
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    return sorted(Run(begin + r.start, r.length, r.period) for begin, end in stretches(ids)
                  for r in find_runs(ids[begin:end]))


def greatest(runs: list[Run]) -> Run | None:
    """The run of greatest exact length / period; ties: smallest start, then period."""
    def compare(a: Run, b: Run) -> int:
        return b.length * a.period - a.length * b.period or a.start - b.start or a.period - b.period
    return min(runs, key=cmp_to_key(compare), default=None)


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that stand in a run after its first period."""
    if not runs:
        return words
    step = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        step[r.start + r.period] += 1
        step[r.start + r.length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


def periodic_runs(documents: DataFrame, prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, `RESULT` columns) of every whole text.

    The columns from start to exponent_milli describe the run of greatest exponent; `collapsed` has the words left,
    joined by blanks. `prepare(doc_id, words)`, if given, changes a text's words before they are searched.
    """

    def row(doc_id: int | None, text: str) -> tuple:
        words = text.encode().split()                     # splits at ASCII white space
        if prepare:
            words = prepare(doc_id, words)
        runs = word_runs(words)
        best = greatest(runs)
        described = (*best, 1000 * best.length // best.period) if best else (None,) * 4
        return len(words), len(runs), *described, [r._asdict() for r in runs], b" ".join(collapsed(words, runs)).decode()

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"]
        types = [pa.int64()] * 6 + [_RUNS, pa.string()]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, texts = (batch.column(k).slice(at, 256) for k in ("doc_id", "text"))
                columns = list(zip(*(row(d, t.as_py()) for d, t in zip(ids.to_pylist(), texts))))
                yield pa.record_batch([ids, *(pa.array(c, t) for c, t in zip(columns, types))], names=names)

    rows = documents.select("doc_id", text_or_empty().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(kernel, f"doc_id {kind}, {RESULT}")


shipped(__name__)
