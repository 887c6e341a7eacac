"""Secret scan: base patterns, and formats inferred from the credentials that those find.

1. Base. Three patterns find credentials: assignments, access keys and long hex strings (`BASE`).
2. Grammar inference. What they find, all over the corpus, are labelled credentials. Of each kind at most
   `CREDENTIALS` different ones, picked by hash, are written as format strings (`format_of`) and make a prefix tree with
   counts. Its states are merged in breadth-first order where they are statistically compatible (Hoeffding's bound on the
   shares of every symbol and of ending, also of all states behind them), which leaves a probabilistic deterministic
   automaton for each kind. Another one is inferred from at most `ORDINARY` different strings outside base spans of
   some `ORDINARY_DOCUMENTS` documents.
3. Scores. Every candidate of every text (a longest run of `[A-Za-z0-9+/_.-]` without dots at its ends, at least `LEAST`
   characters) gets its likelihood under each credential automaton, times that of its characters given their symbols, and
   is reported as kind `format` if it is `ODDS` times as likely as under the ordinary strings' automaton and overlaps no
   base span. Credential automata give a format they never saw no probability, so ordinary words stay out.

Likelihoods are learned on bounded samples; all texts are scanned whole, in Arrow batches. A worker remembers verdicts
of candidates in a table of bounded size.

Defined cases: null text counts as empty (no span); kinds with fewer than `FEWEST` different credentials have no
automaton, and without any only base spans are given (so too in an empty table, which gives no rows); sampled strings of
over `LONGEST` characters are not learned from, but all are scored; equal scores need no order (a candidate is reported
once); repeated rows are each scanned, but teach once; very long texts are scanned whole; other columns, also of
clashing names, are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gamecast.llm.common import shipped, stored, text_or_empty

KINDS = ("assign", "access", "hex")
FORMAT = "format"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KEYWORDS = (b"passw", b"secret", b"token", b"api")      # an assignment holds one of them, in any case
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST_HEX)           # of a longest run, all of it or nothing
LEAST = 6
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.-]+")
CREDENTIALS, ORDINARY, ORDINARY_DOCUMENTS = 2_000, 20_000, 2_000
FEWEST, LONGEST = 20, 256
ALPHA, ODDS, NOVEL = 0.05, 1e6, 1e-3
CONSTANT, CONSTANT_SHARE = 8, 0.95
CACHE, KNOWN_FORMATS = 300_000, 50_000

_DIGITS, _LOWER, _UPPER = b"0123456789", bytes(range(97, 123)), bytes(range(65, 91))
_CANDIDATE_BYTES = bytes(b if chr(b) in "+/_.-" or b in _DIGITS + _LOWER + _UPPER else 32 for b in range(256))
_HEX_BYTES = bytes(120 if b in b"0123456789abcdef" else 32 for b in range(256))
_LONG_HEX = b"x" * LEAST_HEX
#: symbol of a string's letters and digits -> the characters it stands for; a string with digits has the first that holds all of them
ALPHABETS = {"d": _DIGITS, "x": _DIGITS + b"abcdef", "X": _DIGITS + b"ABCDEF", "w": _DIGITS + _LOWER, "U": _DIGITS + _UPPER,
             "m": _DIGITS + _LOWER + _UPPER}
_PUNCTUATION = b"+/_.-"
_BY_CASE = bytes(97 if b in _LOWER else 65 if b in _UPPER else b for b in range(256))
_BY_SYMBOL = {k: bytes(ord(k) if b in _DIGITS + _LOWER + _UPPER else b for b in range(256)) for k in ALPHABETS}
SIZES = {**{s: len(a) for s, a in ALPHABETS.items()}, "a": 26, "A": 26}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed."""
    spans, raw = [], text.encode()
    low = raw.lower()
    if any(k in low for k in KEYWORDS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= LEAST_VALUE]
    if b"AKIA" in raw:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if _LONG_HEX in raw.translate(_HEX_BYTES):
        spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def words(text: str) -> set[bytes]:
    """The different longest runs of candidate characters."""
    return set(text.encode().translate(_CANDIDATE_BYTES).split())


def candidates(text: str) -> set[bytes]:
    """The different candidates of a text."""
    return {c for c in (w.strip(b".") for w in words(text)) if len(c) >= LEAST}


def format_of(s: bytes) -> str:
    """A symbol a character: letters of a string without digits by case; with digits, one symbol for the narrowest
    alphabet that holds its letters and digits; punctuation as it is."""
    solid = s.translate(None, _PUNCTUATION)
    if solid.isalpha() or not solid:
        return s.translate(_BY_CASE).decode()
    kind = next(k for k, letters in ALPHABETS.items() if not solid.translate(None, letters))
    return s.translate(_BY_SYMBOL[kind]).decode()


def with_constants(written: str, s: bytes, constant: list[tuple[int, int]]) -> str:
    """A format string in which characters that `constant` (place, byte) has at their place stay, from U+0100 on."""
    for k, b in constant:
        if k < len(s) and s[k] == b:
            written = written[:k] + chr(256 + b) + written[k + 1:]
    return written


class Automaton:
    """Probabilistic deterministic automaton: state -> {symbol: (next state, count)}, ends and visits."""

    def __init__(self, words: Iterable[str]):
        """The prefix tree of `words`."""
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        self.ends, self.visits = [0], [0]
        for word in words:
            state = 0
            self.visits[0] += 1
            for symbol in word:
                child = self.next[state].get(symbol)
                if child is None:
                    child = self.next[state][symbol] = len(self.next)
                    self.next.append({})
                    self.count.append({})
                    self.ends.append(0)
                    self.visits.append(0)
                self.count[state][symbol] = self.count[state].get(symbol, 0) + 1
                state = child
                self.visits[state] += 1
            self.ends[state] += 1

    def compatible(self, a: int, b: int, alpha: float) -> bool:
        """Whether all shares of two states, and of the states behind both, are within Hoeffding's bound."""
        width = math.sqrt(0.5 * math.log(2 / alpha))
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.visits[a], self.visits[b]
            bound = width * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            here, there = self.count[a], self.count[b]
            for symbol in here.keys() | there.keys():
                if abs(here.get(symbol, 0) / n - there.get(symbol, 0) / m) > bound:
                    return False
                if symbol in here and symbol in there:
                    todo.append((self.next[a][symbol], self.next[b][symbol]))
        return True

    def fold(self, into: int, tree: int) -> None:
        """Add the counts of a part of the prefix tree to a state and those behind it."""
        todo = [(into, tree)]
        while todo:
            a, b = todo.pop()
            self.ends[a] += self.ends[b]
            self.visits[a] += self.visits[b]
            for symbol, child in self.next[b].items():
                self.count[a][symbol] = self.count[a].get(symbol, 0) + self.count[b][symbol]
                if symbol in self.next[a]:
                    todo.append((self.next[a][symbol], child))
                else:
                    self.next[a][symbol] = child

    def merge(self, alpha: float = ALPHA) -> "Automaton":
        """Merge compatible states: each next state of the tree into the first kept state it is compatible with."""
        kept, border = [0], deque((0, s) for s in sorted(self.next[0]))
        is_kept = {0}
        while border:
            parent, symbol = border.popleft()
            state = self.next[parent][symbol]
            if state in is_kept:
                continue
            for other in kept:
                if self.compatible(other, state, alpha):
                    self.next[parent][symbol] = other
                    # folding may hang further parts of the tree below kept states: those are border again
                    self.fold(other, state)
                    border.extend((k, s) for k in kept for s in sorted(self.next[k]) if self.next[k][s] not in is_kept
                                  and (k, s) not in border)
                    break
            else:
                kept.append(state)
                is_kept.add(state)
                border.extend((state, s) for s in sorted(self.next[state]))
        return self

    def table(self) -> dict[int, tuple[float, dict[str, tuple[int, float]]]]:
        """state -> (log share of ending, {symbol: (next state, log share)}) of the states that can be reached."""
        out, todo = {}, [0]
        while todo:
            q = todo.pop()
            if q in out:
                continue
            n = self.visits[q]
            out[q] = (math.log(self.ends[q] / n) if self.ends[q] else -math.inf,
                      {s: (t, math.log(self.count[q][s] / n)) for s, t in self.next[q].items()})
            todo.extend(self.next[q].values())
        return out


@dataclass
class Grammar:
    """An automaton over format strings, and the characters' log shares given their symbols."""
    states: dict[int, tuple[float, dict[str, tuple[int, float]]]]
    letters: dict[str, dict[int, float]]
    constant: list[tuple[int, int]] = field(default_factory=list)
    known: dict[str, float] = field(default_factory=dict)

    def of_format(self, written: str) -> float:
        """Log likelihood of a format string."""
        total, state = 0.0, 0
        for symbol in written:
            step = self.states[state][1].get(symbol)
            if step is None:
                return -math.inf
            state = step[0]
            total += step[1]
        return total + self.states[state][0]

    def likelihood(self, s: bytes, written: str) -> float:
        """Log likelihood of a string of that format; -inf for a format without probability."""
        if self.constant:
            written = with_constants(written, s, self.constant)
        total = self.known.get(written)
        if total is None:                                  # a table of bounded size
            if len(self.known) > KNOWN_FORMATS:
                self.known.clear()
            total = self.known[written] = self.of_format(written)
        if total == -math.inf:
            return total
        return total + sum(self.letters[symbol][b] for symbol, b in zip(written, s) if symbol in SIZES)


def infer(strings: list[bytes], alpha: float = ALPHA, constants: bool = True) -> Grammar:
    """The grammar of different strings. `constants`: keep characters that nearly all of them have at one place."""
    constant = []
    for k in range(CONSTANT if constants else 0):
        for b, n in Counter(s[k] for s in strings if len(s) > k).most_common(1):
            if n >= CONSTANT_SHARE * len(strings):
                constant.append((k, b))
    written = [with_constants(format_of(s), s, constant) for s in strings]
    seen: dict[str, Counter] = {symbol: Counter() for symbol in SIZES}
    for s, symbols in zip(strings, written):
        for symbol, b in zip(symbols, s):
            if symbol in seen:
                seen[symbol][b] += 1
    of_symbol = {**ALPHABETS, "a": _LOWER, "A": _UPPER}
    letters = {symbol: {b: math.log((n[b] + 1) / (n.total() + SIZES[symbol])) for b in of_symbol[symbol]}
               for symbol, n in seen.items()}
    return Grammar(Automaton(written).merge(alpha).table(), letters, constant)


@dataclass
class Formats:
    """Grammars of credentials by kind, and that of ordinary strings."""
    credentials: dict[str, Grammar] = field(default_factory=dict)
    ordinary: Grammar | None = None

    def score(self, s: bytes) -> float:
        """Log of how much likelier a string is as a credential than as an ordinary string."""
        written, best = format_of(s), -math.inf
        for g in self.credentials.values():
            best = max(best, g.likelihood(s, written))
        if best == -math.inf:
            return best
        known = self.ordinary.likelihood(s, written) if self.ordinary else -math.inf
        # an unknown format: any of 67 characters, or the end, at every place
        novel = math.log(NOVEL) - (len(s) + 1) * math.log(68)
        high = max(known + math.log1p(-NOVEL), novel)
        return best - high - math.log(math.exp(known + math.log1p(-NOVEL) - high) + math.exp(novel - high))


def learn(samples: dict[str, list[bytes]], alpha: float = ALPHA, fewest: int = FEWEST) -> Formats:
    found = {k: infer(sorted(samples[k]), alpha) for k in KINDS if len(samples.get(k, ())) >= fewest}
    ordinary = sorted(samples.get(FORMAT, ()))
    return Formats(found, infer(ordinary, alpha, constants=False) if ordinary else None)


def labelled(documents: DataFrame, share: float) -> DataFrame:
    """(kind, value): the different strings of base spans, and (kind `format`) of other candidates in a `share` of documents."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[tuple[str, bytes]] = set()
            for t, ordinary in zip(batch.column("text"), batch.column("ordinary").to_pylist()):
                text = t.as_py()
                spans = base_spans(text)
                for kind, start, end in spans:
                    value = text[start:end]
                    if kind == "assign":
                        value = ASSIGN.match(value).group(2)
                    found.update((kind, c) for c in candidates(value) if len(c) <= LONGEST)
                if ordinary:
                    for _, start, end in reversed(spans):
                        text = f"{text[:start]} {text[end:]}"
                    found.update((FORMAT, c) for c in candidates(text) if len(c) <= LONGEST)
            kinds, values = zip(*found) if found else ((), ())
            yield pa.record_batch([pa.array(kinds, pa.string()), pa.array([v.decode() for v in values], pa.string())],
                                  names=["kind", "value"])

    rows = documents.select(text_or_empty().alias("text")).select(
        "text", (F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30))).alias("ordinary"))
    return rows.mapInArrow(kernel, "kind string, value string").distinct()


def sampled(values: DataFrame, sizes: dict[str, int]) -> dict[str, list[bytes]]:
    """About `sizes[kind]` values of each kind, the same ones whatever the partitions: those of the smallest hashes."""
    totals = {r["kind"]: r["count"] for r in values.groupBy("kind").count().collect()}
    place = F.pmod(F.xxhash64("value"), F.lit(1 << 30))
    chosen = F.lit(False)
    for kind, n in totals.items():
        share = min(1.0, sizes[kind] / n)
        chosen = chosen | ((F.col("kind") == kind) & (place < int(share * (1 << 30))))
    out: dict[str, list[bytes]] = {}
    for r in values.where(chosen).collect():               # bounded by `sizes`
        out.setdefault(r["kind"], []).append(r["value"].encode())
    return out


def fit(documents: DataFrame) -> Formats:
    """Infer the formats from the credentials of all documents."""
    share = min(1.0, ORDINARY_DOCUMENTS / max(1, documents.count()))
    values = stored(labelled(documents, share), "credentials")
    return learn(sampled(values, {**dict.fromkeys(KINDS, CREDENTIALS), FORMAT: ORDINARY}))


class Verdicts:
    """Which candidates score as credentials; remembers those that don't, in a table of bounded size."""

    def __init__(self, formats: Formats, odds: float):
        self.formats, self.least = formats, math.log(odds)
        self.ordinary: set[bytes] = set()

    def hits(self, text: str) -> set[bytes]:
        """The candidates of a text that are credentials."""
        out, new = set(), words(text) - self.ordinary
        for word in new:
            c = word.strip(b".")
            if len(c) >= LEAST and self.formats.score(c) >= self.least:
                out.add(c)
            else:
                self.ordinary.add(word)
        if len(self.ordinary) > CACHE:
            self.ordinary.clear()
        return out


def all_spans(text: str, verdicts: Verdicts) -> list[tuple[str, int, int]]:
    """Base spans, and the candidates outside them that score as credentials; by start, then kind as listed."""
    spans = base_spans(text)
    hits = verdicts.hits(text)
    if not hits:
        return spans
    more = []
    for m in CANDIDATE.finditer(text):
        c = m.group().encode()
        start = m.start() + len(c) - len(c.lstrip(b"."))
        c = c.strip(b".")
        if c in hits and not any(a < start + len(c) and start < b for _, a, b in spans):
            more.append((FORMAT, start, start + len(c)))
    return sorted(spans + more, key=lambda s: (s[1], (*KINDS, FORMAT).index(s[0])))


def scanned(documents: DataFrame, formats: Formats, odds: float = ODDS) -> DataFrame:
    """(doc_id, spans array of (kind, start, end)) of every whole text; places in code points, the end exclusive."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdicts = Verdicts(formats, odds)
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in all_spans(t.as_py(), verdicts)]
                     for t in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"])

    rows = documents.select("doc_id", text_or_empty().alias("text"))
    of_id = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(kernel, f"doc_id {of_id}, spans array<struct<kind:string,start:long,end:long>>")


def secret_scan(documents: DataFrame) -> DataFrame:
    """Infer the formats, scan all documents."""
    return scanned(documents, fit(documents))


def digest(scans: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) with spans written as kind:start:end, comma-joined."""
    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return scans.select("doc_id", *[of(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(written(F.filter("spans", lambda s: s["kind"] != FORMAT)), 256).alias("base_sha256"),
                        written("spans").alias("spans"))


shipped(__name__)
