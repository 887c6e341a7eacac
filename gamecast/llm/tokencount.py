"""Word-piece token counts by a linear longest-match automaton (no pieces are built).

The vocabulary has pieces that start a word and pieces that continue one. Two tries hold them. A node's failure link
leads to where matching goes on when no child fits: the pieces that greedy longest-match-first would have taken by then
are *popped*, and their number is stored at the node beforehand. A word is read once, character by character, each
character either goes down an edge or follows links that pop at least one piece, so the work is linear in the word. A
word that cannot be cut into pieces counts as one unknown token.

Words are `[^\\x20\\x09-\\x0D]+`. A worker remembers the counts of words it has seen, in a table of bounded size.

Defined cases: null text counts as empty (no words, no tokens); repeated rows are each counted; an empty table gives
no rows; other columns are ignored; very long words need no limit.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gamecast.llm.common import process_cache, shipped, text_or_empty

CACHE_WORDS = 200_000


class LongestMatch:
    """The automaton: `edges[node]` (char -> node), `link[node]`, `popped[node]`; node 0 starts words, node 1 continues."""

    def __init__(self, initial: Iterable[str], continuing: Iterable[str]):
        self.edges: list[dict[str, int]] = [{}, {}]
        ends: set[int] = set()
        for root, pieces in ((0, initial), (1, continuing)):
            for piece in pieces:
                node = root
                for ch in piece:
                    node = self.edges[node].setdefault(ch, len(self.edges))
                    if node == len(self.edges):
                        self.edges.append({})
                if piece:
                    ends.add(node)
        self.link: list[int | None] = [None] * len(self.edges)
        self.popped = [0] * len(self.edges)
        todo = deque([(0, ch, v) for ch, v in self.edges[0].items()] + [(1, ch, v) for ch, v in self.edges[1].items()])
        while todo:
            parent, ch, node = todo.popleft()
            if node in ends:
                self.link[node], self.popped[node] = 1, 1
            else:
                at, n = self.link[parent], self.popped[parent]
                while at is not None and ch not in self.edges[at]:
                    n += self.popped[at]
                    at = self.link[at]
                if at is not None:
                    self.link[node], self.popped[node] = self.edges[at][ch], n
            todo.extend((node, c, v) for c, v in self.edges[node].items())

    def count(self, word: str) -> int:
        """Pieces of `word` by greedy longest match; -1 if it has none. An empty word has 0."""
        edges, link, popped = self.edges, self.link, self.popped
        node, n = 0, 0
        for ch in word:
            while (nxt := edges[node].get(ch)) is None:
                n += popped[node]
                node = link[node]
                if node is None:
                    return -1
            node = nxt
        while node > 1:
            n += popped[node]
            node = link[node]
            if node is None:
                return -1
        return n


class WordCounts(dict):
    """word (bytes) -> tokens; unknown words count 1."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(word.decode())
        self[word] = n = 1 if n < 0 else n
        return n


def sentencepiece_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """(pieces that start a word, pieces that continue one) of a sentencepiece model's ordinary pieces.

    A piece that begins with the word mark U+2581 starts a word; every other one continues it.
    """
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
             if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
    return [p[1:] for p in plain if p[0] == "▁" and p[1:]], [p for p in plain if p[0] != "▁"]


def _counts(path: str) -> WordCounts:
    kept, key = process_cache(), ("word counts", path)
    if key not in kept:
        kept[key] = WordCounts(LongestMatch(*sentencepiece_vocabulary(path)))
    return kept[key]


def token_counts(documents: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens) of every whole text. `vocabulary`: path of a sentencepiece model."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(vocabulary)
        get = counts.__getitem__
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                words = text.as_buffer().to_pybytes().split()   # splits at ASCII white space
                if len(counts) > CACHE_WORDS:
                    counts.clear()
                rows.append((len(words), sum(map(get, words))))
            n_words, n_tokens = zip(*rows) if rows else ((), ())
            yield pa.record_batch([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                                  names=["doc_id", "n_words", "n_tokens"])

    rows = documents.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(kernel, f"doc_id {kind}, n_words long, n_tokens long")


shipped(__name__)
