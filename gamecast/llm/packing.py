"""Best-fit packing of token sequences with a swap-based local search.

Documents are cut into pieces of at most `capacity` tokens (only longer documents are cut). Pieces are dealt at random
into groups of about `GROUP_PIECES`; the number of groups grows with the pieces, a group never does. A task packs a
group: best-fit decreasing first, then a local search over the bins that are not full. It exchanges a piece for a
larger one of another bin, a piece for two pieces, or moves a piece over, whenever this raises the sum of squared
fills. So room gathers in the emptiest bins until they are empty and go. As groups are large, what dealing costs is
below one bin a group.

Defined cases: null texts are empty (one piece: the end id); repeated rows are packed each; pieces of equal length are
taken in the order in which they were written; a very long text is encoded whole and cut into as many pieces as it needs,
of which only the last is not full; an empty table gives no rows; other columns, also of clashing names, are ignored;
pieces longer than the capacity are refused.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gamecast.llm import tokenids
from gamecast.llm.common import shipped, stored, text_or_empty

CAPACITY = 2048
GROUP_PIECES = 20_000
PASSES = 12
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0,
                 kind: type = tokenids.BareWordIds) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and its end id in pieces of `capacity`."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenids.loaded(kind, tokenizer)
        end = words.packed([end_id])
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(),
                                tokenids.ids_of(words, (t.as_py() for t in batch.column("text")))):
                ids = np.frombuffer(ids + end, "<u2").astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity]
                    rows.append((doc, k, at, len(part), zlib.crc32(part.tobytes())))
            columns = zip(*rows) if rows else [()] * 5
            yield pa.record_batch([pa.array(c, t) for c, t in zip(
                columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(kernel, PIECES)


class Bins:
    """Bins of one group. `where[size]` has the open bins that hold a piece of that size."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[tuple[int, int]]] = []     # (size, piece), sorted
        self.fill: list[int] = []
        self.where: dict[int, set[int]] = defaultdict(set)

    def best_fit(self, sizes: np.ndarray) -> None:
        """Largest piece first, each into the fullest bin that it fits into."""
        room: dict[int, list[int]] = defaultdict(list)
        rooms: list[int] = []                            # the distinct room sizes there are, ascending
        for piece in np.argsort(-sizes, kind="stable").tolist():
            size = int(sizes[piece])
            k = bisect_left(rooms, size)
            if k < len(rooms):
                left = rooms[k]
                b = room[left].pop()
                if not room[left]:
                    del rooms[k]
            else:
                b, left = len(self.items), self.capacity
                self.items.append([])
                self.fill.append(0)
            insort(self.items[b], (size, piece))
            self.fill[b] += size
            left -= size
            if left:
                if not room[left]:
                    insort(rooms, left)
                room[left].append(b)

    def open(self) -> list[int]:
        return [b for b, f in enumerate(self.fill) if 0 < f < self.capacity]

    def put(self, b: int, item: tuple[int, int]) -> None:
        insort(self.items[b], item)
        self.fill[b] += item[0]
        self.where[item[0]].add(b)

    def take(self, b: int, item: tuple[int, int]) -> None:
        self.items[b].remove(item)
        self.fill[b] -= item[0]
        if not any(s == item[0] for s, _ in self.items[b]):
            self.where[item[0]].discard(b)

    def holder(self, size: int, a: int, gain: int) -> int | None:
        """An open bin other than `a` with a piece of `size`, emptier than bin a will be: squared fill rises."""
        best = None
        for k, b in enumerate(self.where.get(size, ())):
            if b != a and self.fill[b] < self.fill[a] + gain and (best is None or self.fill[b] < self.fill[best]):
                best = b
            if k == 8 and best is not None:
                break
        return best

    def improve(self, a: int) -> bool:
        """The exchange or move into bin a that leaves it the least room; False if there is none."""
        room, fill = self.capacity - self.fill[a], self.fill[a]
        for gain in range(room, 0, -1):
            b = self.holder(gain, a, gain)                               # move
            if b is not None:
                self.move(b, a, gain)
                return True
            for size, piece in self.items[a]:                            # one for one
                b = self.holder(size + gain, a, gain)
                if b is not None:
                    self.move(b, a, size + gain)
                    self.take(a, (size, piece))
                    self.put(b, (size, piece))
                    return True
            if gain == room:                                             # two for one, only to fill the bin
                for size, piece in self.items[a]:
                    pair = self.pair(size + gain, a, gain)
                    if pair:
                        b, first, second = pair
                        for item in (first, second):
                            self.take(b, item)
                            self.put(a, item)
                        self.take(a, (size, piece))
                        self.put(b, (size, piece))
                        return True
        assert self.fill[a] == fill
        return False

    def pair(self, total: int, a: int, gain: int) -> tuple | None:
        """A bin with two pieces of `total` tokens together, looked for among its bins with many pieces."""
        for b in self.many:
            if b != a and 0 < self.fill[b] < self.fill[a] + gain:
                seen: dict[int, tuple[int, int]] = {}
                for item in self.items[b]:
                    other = seen.get(total - item[0])
                    if other:
                        return b, other, item
                    seen[item[0]] = item
        return None

    def move(self, b: int, a: int, size: int) -> None:
        item = next(i for i in self.items[b] if i[0] == size)
        self.take(b, item)
        self.put(a, item)

    def search(self, passes: int) -> None:
        """Passes over the open bins, fullest first, until none can be improved."""
        for b in self.open():
            for size, _ in self.items[b]:
                self.where[size].add(b)
        for _ in range(passes):
            bins = sorted(self.open(), key=self.fill.__getitem__, reverse=True)
            self.many = [b for b in bins[::-1] if len(self.items[b]) > 2][:16]
            changed = False
            for a in bins:
                while 0 < self.fill[a] < self.capacity and self.improve(a):
                    changed = True
                if self.fill[a] == self.capacity:                        # full: its pieces stay
                    for size, _ in self.items[a]:
                        self.where[size].discard(a)
            if not changed:
                return


def pack_sizes(sizes: np.ndarray, capacity: int = CAPACITY, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; bins are numbered from 0 without gaps, and so are places in a bin."""
    if len(sizes) and (sizes.max() > capacity or sizes.min() < 1):
        raise ValueError("pieces must have 1 to `capacity` tokens")
    bins = Bins(capacity)
    bins.best_fit(sizes)
    bins.search(passes)
    bin_of, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    n = 0
    for items in bins.items:
        if items:
            at = 0
            for size, piece in items[::-1]:
                bin_of[piece], offset[piece] = n, at
                at += size
            n += 1
    return bin_of, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, passes: int = PASSES) -> DataFrame:
    """`pieces` (rows with a `length` of 1 to `capacity`) with `sequence_id` and `offset`.

    The pieces are written once, since their number sets the number of groups.
    """
    pieces = stored(pieces, "pieces")
    n_groups = max(1, -(-pieces.count() // group_pieces))
    columns = pieces.columns

    def kernel(key: tuple, group: pa.Table) -> pa.Table:
        order = np.lexsort([group.column(c).to_numpy() for c in ("tie", "length")])
        group = group.take(pa.array(order))
        bin_of, offset = pack_sizes(group.column("length").to_numpy(), capacity, passes)
        return (group.select(columns).append_column("sequence_id", pa.array((key[0].as_py() << 32) + bin_of))
                .append_column("offset", pa.array(offset)))

    dealt = (pieces.withColumn("tie", F.monotonically_increasing_id())    # repeated rows are dealt apart
             .withColumn("group", F.pmod(F.xxhash64("tie"), F.lit(n_groups))))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return (dealt.repartition(n_groups, "group").groupBy("group")
            .applyInArrow(kernel, f"{schema}, sequence_id long, offset long"))


shipped(__name__)
