"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is normalised by the library and cut into chunks that no merge can cross: no piece of such a vocabulary has a
word mark (U+2581) behind another character, and characters that are in no piece never merge. Both are checked on
the vocabulary when it is loaded; where the first fails, the whole text is one chunk. In a chunk, an **agenda** holds
every adjacent pair of symbols whose join is a piece, best score first, the leftmost of equals first. The best pair
is merged, the pairs with its new neighbours join the agenda, and pairs whose symbols have changed since are passed
over. Symbols that are no piece become byte pieces, or the unknown id.

Every chunk that a worker meets for the first time is also given to the sentencepiece library, together for an Arrow
batch, and the ids have to be the same. Texts whose chunks are not remembered (no word mark in front, marks in a row, a
mark before a line break) are given to it whole each time; `check_texts=True` holds every whole text against the library as well.

Defined cases: null and empty texts have no ids and decode to an empty text; repeated rows are each encoded; an empty
table gives no rows; other columns are ignored; texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from gamecast.llm.common import process_cache, shipped, text_or_empty

MARK = "▁"
CACHE_CHUNKS = 300_000


class MergePieces(dict):
    """chunk key -> (decimal ids joined by commas, ids). A key is a chunk without its word mark, or starts with a line break."""

    def __init__(self, path: str):
        import sentencepiece
        super().__init__()
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score, self.id, self.bytes, self.unknown = {}, {}, {}, sp.unk_id()
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_unused(i):
                raise ValueError("vocabularies with unused pieces are not supported")
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                self.score[piece], self.id[piece] = sp.get_score(i), i
        self.splits = not any(regex.search(f"[^{MARK}]{MARK}", p) for p in self.score)
        self.break_alone = self.splits and not any("\n" in p for p in self.score)
        # characters that stand side by side in some piece; merges never cross the border between any others
        self.beside = {p[k:k + 2] for p in self.score for k in range(len(p) - 1)}
        self.tails: dict[str, tuple[int, ...]] = {}
        self.fresh: list[str] = []
        self.whole: list[tuple[str, list[int]]] = []
        self.before: dict = {}

    def agenda(self, text: str) -> list[int]:
        """Ids of normalised text by merging the best adjacent pair again and again."""
        score, symbols = self.score, list(text)
        n = len(symbols)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(-score[joined], i, i + 1, joined)
                  for i, joined in enumerate(map(str.__add__, symbols, symbols[1:])) if joined in score]
        heapq.heapify(agenda)
        while agenda:
            _, i, j, joined = heapq.heappop(agenda)
            if not symbols[i] or not symbols[j] or len(symbols[i]) + len(symbols[j]) != len(joined):
                continue
            symbols[i], symbols[j] = joined, ""
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                pair = joined + symbols[k]
                if pair in score:
                    heapq.heappush(agenda, (-score[pair], i, k, pair))
            h = left[i]
            if h >= 0:
                pair = symbols[h] + joined
                if pair in score:
                    heapq.heappush(agenda, (-score[pair], h, i, pair))
        ids = []
        for s in symbols:
            if s:
                got = self.id.get(s)
                if got is not None:
                    ids.append(got)
                elif self.bytes:
                    ids.extend(self.bytes[b] for b in s.encode())
                else:
                    ids.append(self.unknown)
        return ids

    def __missing__(self, key: str) -> tuple[str, tuple[int, ...]]:
        kept = self.before.get(key)
        if kept is None:
            end = len(key)
            while end > 1 and not key[end - 1].isalnum():
                end -= 1
            if 1 < end < len(key) and key[end - 1:end + 1] not in self.beside:     # a word and what follows it
                text, ids = self[key[:end]]
                tail = self.tail(key[end:])
                kept = (",".join((text, *map(str, tail))), ids + tail)
            else:
                ids = self.agenda("\n") + self.agenda(key[1:]) if key[:1] == "\n" else self.agenda(MARK + key)
                kept = (",".join(map(str, ids)), tuple(ids))
            self.fresh.append(key)
        self[key] = kept
        return kept

    def tail(self, text: str) -> tuple[int, ...]:
        ids = self.tails.get(text)
        if ids is None:
            if len(self.tails) > 10_000:
                self.tails.clear()
            ids = self.tails[text] = tuple(self.agenda(text))
        return ids

    def check(self) -> None:
        """Hold the chunks, and the texts without such chunks, met since the last check against the library."""
        if self.fresh:
            mark = tuple(self.agenda(MARK))
            for key, ids in zip(self.fresh, self.library.encode(self.fresh, num_threads=1)):
                mine = self[key][1]
                if (mark + mine if key[:1] == "\n" else mine) != tuple(ids) and key:
                    raise ValueError(f"ids of {key!r} differ from the library's")
            self.fresh.clear()
        if self.whole:
            texts, mine = zip(*self.whole)
            self.whole.clear()
            for text, ids, theirs in zip(texts, mine, self.library.encode(list(texts), num_threads=1)):
                if ids != theirs:
                    raise ValueError(f"ids of {text[:200]!r} differ from the library's")
        if len(self) > CACHE_CHUNKS:
            self.before = dict(self)
            self.clear()

    def encode(self, text: str) -> tuple[str, list[int]]:
        normal = self.library.normalize(text)
        if not normal:
            return "", []
        if not self.splits or normal[0] != MARK or MARK + MARK in normal or MARK + "\n" in normal:
            chunks = regex.findall(f"{MARK}*[^{MARK}]+|{MARK}+$", normal) if self.splits else [normal]
            ids = list(chain.from_iterable(map(self.agenda, chunks)))
            self.whole.append((text, ids))
            return ",".join(map(str, ids)), ids
        keys = normal[1:]
        if self.break_alone and "\n" in keys:
            keys = keys.replace("\n", MARK + "\n")
        texts, ids = zip(*map(self.__getitem__, keys.split(MARK)))
        return ",".join(texts), list(chain.from_iterable(ids))


def _pieces(path: str) -> MergePieces:
    kept, key = process_cache(), ("merge pieces", path)
    if key not in kept:
        kept[key] = MergePieces(path)
    return kept[key]


def encode_decode(documents: DataFrame, model: str, check_texts: bool = False, block_chars: int = 2_000_000,
                  id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids array<int>, decoded) of every whole text; with `digest`, SHA-256 of both instead."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        library = pieces.library
        for batch in batches:
            texts, at = batch.column("text"), 0
            while at < len(texts):      # blocks of bounded size: long texts come a few at a time
                block, chars = [], 0
                while at + len(block) < len(texts) and (not block or chars < block_chars):
                    block.append(texts[at + len(block)].as_py())
                    chars += len(block[-1])
                coded = [pieces.encode(t) for t in block]
                pieces.check()
                if check_texts and [ids for _, ids in coded] != library.encode(block, num_threads=1):
                    raise ValueError("ids of a text differ from the library's")
                decoded = [library.decode(ids) if ids else "" for _, ids in coded]
                columns = [batch.column("doc_id").slice(at, len(block)),
                           pa.array([len(ids) for _, ids in coded], pa.int64())]
                if digest:
                    columns += [pa.array([hashlib.sha256(t.encode()).hexdigest() for t, _ in coded], pa.string()),
                                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string())]
                else:
                    columns += [pa.array([ids for _, ids in coded], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                yield pa.record_batch(columns, names=names)
                at += len(block)

    rows = documents.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    names = ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"])]
    types = ["string", "string"] if digest else ["array<int>", "string"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(kernel, f"doc_id {kind}, n_tokens long, {names[2]} {types[0]}, {names[3]} {types[1]}")


shipped(__name__)
