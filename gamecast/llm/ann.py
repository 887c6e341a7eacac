"""Approximate nearest neighbours by cosine: inverted lists, scanned by an adaptive number of dimensions.

An index is a set of centroids (spherical k-means) and a random rotation, fitted on a bounded sample of
`SAMPLE_ROWS` vectors. Every vector goes to the list of its nearest centroid; every query probes the nearest lists.
Lists are packed into chunks of at most `CHUNK_ROWS` vectors and queries into blocks of at most `BLOCK_ROWS`, salted by
counts, so neither a hot list nor many copies of one vector meet in one task. A chunk and a block of the same list are
scanned together: normalised vectors are rotated and laid out in column blocks of `COLUMNS` dimensions, squared
distances grow block by block, and after each block a hypothesis test gives up the candidates whose distance, estimated
from the dimensions seen so far, is above the query's bound with high confidence (`EPSILON`). The bound is the distance
to the k-th nearest of a part of the sample (`BOUND_ROWS`, whose nearest are also answers), and then of what the chunk
has shown. Survivors get their exact cosine, in double
precision on the original vectors.

On vectors without any cluster structure near neighbours are spread over most lists, so `PROBE_SHARE` is high; see the
README for the recall measured against brute force.

Defined cases: vectors that are null, zero, of another dimension than most of the sample, or hold null or non-finite
components take no part, nor do null ids; rows with equal ids count as one candidate (the nearer one), and never as an
answer to that id's query; equal scores rank by id; fewer candidates than k give fewer rows; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gamecast.llm.common import shipped

LISTS, PROBE_SHARE = 64, 0.72
SAMPLE_ROWS, BOUND_ROWS = 16_384, 4_096
CHUNK_ROWS, BLOCK_ROWS, GROUP_ROWS = 4_096, 256, 32_768
COLUMNS, EPSILON = 16, 2.1
PACKED = "list int, salt int, ids binary, vectors binary"


@dataclass
class Index:
    centroids: np.ndarray      # lists x dim, unit length
    rotation: np.ndarray       # dim x dim, orthogonal
    sample: np.ndarray         # vectors of the corpus as they are, for first bounds
    sample_ids: np.ndarray
    probes: int

    @property
    def dim(self) -> int:
        return self.rotation.shape[0]


def usable(vector: str = "vector") -> Column:
    return (F.col("vec_id").isNotNull() & F.col(vector).isNotNull()
            & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
            & F.exists(vector, lambda x: x != 0))


def vectors_of(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector array<double>) of the rows that take part, but for the dimension."""
    return embeddings.select(F.col(id_col).cast("long").alias("vec_id"),
                             F.col(vector_col).cast("array<double>").alias("vector")).where(usable())


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow or underflow of the squares."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit(vectors: DataFrame, lists: int = LISTS, probe_share: float = PROBE_SHARE, sample_rows: int = SAMPLE_ROWS) -> Index | None:
    """The index of `vectors`, from at most `sample_rows` of them chosen by hash of the id. None if there are none."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect()
    if not rows:
        return None
    (dim, _), = Counter(len(r.vector) for r in rows).most_common(1)
    rows = [r for r in rows if len(r.vector) == dim]
    x = unit(np.array([r.vector for r in rows]))
    rng = np.random.default_rng(11)
    distinct = np.unique(x, axis=0)
    lists = max(1, min(lists, len(distinct) // 16))
    centroids = distinct[rng.choice(len(distinct), lists, replace=False)]
    for _ in range(12):
        near = (x @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, x)
        full = np.sqrt((sums * sums).sum(1)) > 1e-9          # lists that nothing is nearest to go
        centroids = sums[full] / np.sqrt((sums[full] ** 2).sum(1, keepdims=True))
    rotation, r = np.linalg.qr(rng.standard_normal((dim, dim)))
    probes = max(1, min(len(centroids), max(8, round(probe_share * len(centroids)))))
    return Index(centroids, rotation * np.sign(np.diag(r)), np.array([r.vector for r in rows[:BOUND_ROWS]]),
                 np.array([r.vec_id for r in rows[:BOUND_ROWS]], np.int64), probes)


def _matrix(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("vector")
    fits = np.array(column.value_lengths().to_numpy() == dim)
    if not fits.all():
        batch = batch.filter(pa.array(fits))
        column = batch.column("vector")
    return batch.column("vec_id").to_numpy(), column.flatten().to_numpy().reshape(-1, dim)


def _listed(index: Index, n_lists: int):
    """Rows (list, vec_id, vector) for the `n_lists` nearest lists of each vector."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = _matrix(batch, index.dim)
            for at in range(0, len(ids), 4096):
                part = x[at:at + 4096]
                near = np.argpartition(-(unit(part) @ index.centroids.T), n_lists - 1, axis=1)[:, :n_lists] \
                    if n_lists < len(index.centroids) else np.tile(np.arange(n_lists), (len(part), 1))
                raw = [v.tobytes() for v in part]
                yield pa.record_batch([pa.array(near.ravel().astype(np.int32)),
                                       pa.array(np.repeat(ids[at:at + 4096], n_lists)),
                                       pa.array([v for v in raw for _ in range(n_lists)], pa.binary())],
                                      names=["list", "vec_id", "vector"])

    return kernel


def _pack(rows: int):
    """Runs of one (list, salt) into rows of at most `rows` vectors."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, vectors = None, [], []

        def packed() -> pa.RecordBatch:
            out = pa.record_batch([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()),
                                   pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
                                   pa.array([b"".join(vectors)], pa.binary())], names=["list", "salt", "ids", "vectors"])
            ids.clear()
            vectors.clear()
            return out

        for batch in batches:
            for key, i, v in zip(zip(batch.column("list").to_pylist(), batch.column("salt").to_pylist()),
                                 batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist()):
                if ids and (key != now or len(ids) == rows):
                    yield packed()
                now = key
                ids.append(i)
                vectors.append(v)
        if ids:
            yield packed()

    return kernel


def packed_lists(listed: DataFrame, salts: int, rows: int) -> DataFrame:
    salted = listed.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).cast("int"))
    return (salted.repartition("list", "salt").sortWithinPartitions("list", "salt", "vec_id")
            .mapInArrow(_pack(rows), PACKED))


def in_range(x: np.ndarray) -> np.ndarray:
    """Rows scaled by powers of two, which rounds nothing, so that squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0, keepdims=True))[1])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of paired rows in double precision."""
    a, b = in_range(a), in_range(b)
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def by_id(far: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(each query's least distance to every different id, the position of its row), of distances to rows of `ids`."""
    order = np.argsort(ids, kind="stable")
    starts = np.flatnonzero(np.append(True, ids[order][1:] != ids[order][:-1]))
    if len(starts) == len(ids):
        return far, np.broadcast_to(np.arange(len(ids)), far.shape)
    far = far[:, order]
    least = np.minimum.reduceat(far, starts, axis=1)
    first = far == np.repeat(least, np.diff(starts, append=len(ids)), axis=1)
    return least, np.minimum.reduceat(np.where(first, order[None, :], len(ids)), starts, axis=1)


def kth_distance(far: np.ndarray, k: int) -> np.ndarray:
    """The k-th least of each row, infinite where there are fewer."""
    return np.partition(far, k - 1, axis=1)[:, k - 1] if k <= far.shape[1] else np.full(len(far), np.inf)


def nearest_of_sample(index: Index, ids: np.ndarray, raw: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(squared distance of each query's k-th nearest id in the sample, itself left out; the positions of those k).

    The distance is never below that of the true k-th nearest; where the sample has fewer ids it is infinite.
    """
    far = 2 - 2 * (unit(raw).astype(np.float32) @ unit(index.sample).astype(np.float32).T)
    far[ids[:, None] == index.sample_ids[None, :]] = np.inf
    far, at = by_id(far, index.sample_ids)
    bound, k = kth_distance(far, k) + 1e-5, min(k, far.shape[1])
    near = np.argpartition(far, k - 1, axis=1)[:, :k]
    return bound, np.take_along_axis(at, near, 1), np.take_along_axis(far, near, 1)


def _sampled(index: Index, k: int):
    """Each query's nearest rows of the sample, as first answers."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raw = _matrix(batch, index.dim)
            for at in range(0, len(ids), 1024):
                part, own = raw[at:at + 1024], ids[at:at + 1024]
                _, near, far = nearest_of_sample(index, own, part, k)
                q = np.repeat(np.arange(len(own)), near.shape[1])[np.isfinite(far.ravel())]
                x = near.ravel()[np.isfinite(far.ravel())]
                yield pa.record_batch([pa.array(own[q]), pa.array(index.sample_ids[x]),
                                       pa.array(cosines(part[q], index.sample[x]))], names=["query_id", "vec_id", "score"])

    return kernel


def scan(index: Index, ids: np.ndarray, raw: np.ndarray, query_ids: np.ndarray, query_raw: np.ndarray, k: int
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, candidate position, cosine) of each query's k best of one chunk, as far as the tests let them."""
    dim = index.dim
    x, q = ((unit(m) @ index.rotation).astype(np.float32) for m in (raw, query_raw))
    bound = nearest_of_sample(index, query_ids, query_raw, k)[0]
    if len(x) > 4 * k:      # the chunk's own first vectors tighten the bound
        head = min(len(x), 512)
        far = 2 - 2 * (q @ x[:head].T)
        far[query_ids[:, None] == ids[None, :head]] = np.inf
        bound = np.minimum(bound, kth_distance(by_id(far, ids[:head])[0], k) + 1e-5)
    blocks = [slice(at, min(at + COLUMNS, dim)) for at in range(0, dim, COLUMNS)]
    first = blocks[0]
    part = ((q[:, first] ** 2).sum(1)[:, None] + (x[:, first] ** 2).sum(1)[None, :] - 2 * (q[:, first] @ x[:, first].T))
    part = np.maximum(part, 0)
    seen = first.stop
    at_q, at_x = np.nonzero((part * (dim / seen) <= _limit(bound, seen, dim)[:, None]) & (query_ids[:, None] != ids[None, :]))
    far = part[at_q, at_x]
    for block in blocks[1:]:
        far = far + ((q[at_q, block] - x[at_x, block]) ** 2).sum(1)
        seen = block.stop
        alive = far * (dim / seen) <= _limit(bound, seen, dim)[at_q]
        at_q, at_x, far = at_q[alive], at_x[alive], far[alive]
    # a few more than k ids, as distances are single precision here
    one = _one_a_query(at_q, ids[at_x], far)
    one = one[np.lexsort([far[one], at_q[one]])]
    kth = np.full(len(q), np.inf)
    last = one[_ranks(at_q[one], len(q)) == k - 1]
    kth[at_q[last]] = far[last] + 1e-5
    near = far <= kth[at_q]
    at_q, at_x = at_q[near], at_x[near]
    cosine = cosines(query_raw[at_q], raw[at_x])
    one = _one_a_query(at_q, ids[at_x], -cosine)
    one = one[np.lexsort([ids[at_x[one]], -cosine[one], at_q[one]])]
    best = one[_ranks(at_q[one], len(q)) < k]
    return at_q[best], at_x[best], cosine[best]


def _one_a_query(at_q: np.ndarray, ids: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Positions of the nearest row of each (query, id)."""
    order = np.lexsort([far, ids, at_q])
    q, i = at_q[order], ids[order]
    return order[(np.diff(q, prepend=-1) != 0) | np.append(True, i[1:] != i[:-1])[:len(i)]]


def _ranks(at_q: np.ndarray, n: int) -> np.ndarray:
    """Places of rows, sorted by query, within their query."""
    return np.arange(len(at_q)) - np.searchsorted(at_q, np.arange(n))[at_q]


def _limit(bound: np.ndarray, seen: int, dim: int) -> np.ndarray:
    """Estimated squared distances above this reject 'nearer than the bound'; at full dimension the bound itself."""
    return bound if seen >= dim else bound * (1 + EPSILON / np.sqrt(seen)) ** 2


def search(embeddings: DataFrame, is_query: Column, k: int = 5, lists: int = LISTS, probe_share: float = PROBE_SHARE,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that `is_query` (over vec_id) chooses."""
    spark = embeddings.sparkSession
    vectors = vectors_of(embeddings, id_col, vector_col)
    index = fit(vectors, lists, probe_share)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n, n_queries = vectors.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    n_lists = len(index.centroids)
    salts = max(1, -(-n // (n_lists * GROUP_ROWS)))
    query_salts = max(1, -(-n_queries * index.probes // (n_lists * GROUP_ROWS)))
    listed = "list int, vec_id long, vector binary"
    chunks = packed_lists(vectors.mapInArrow(_listed(index, 1), listed), salts, CHUNK_ROWS)
    blocks = packed_lists(vectors.where(is_query).mapInArrow(_listed(index, index.probes), listed), query_salts, BLOCK_ROWS)
    blocks = blocks.select("list", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
                           F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in zip(*(batch.column(c) for c in ("ids", "vectors", "query_ids", "queries"))):
                ids, raw, query_ids, queries = (np.frombuffer(c.as_buffer(), t) for c, t in zip(columns, ("<i8", "<f8") * 2))
                raw, queries = raw.reshape(-1, index.dim), queries.reshape(-1, index.dim)
                at_q, at_x, cosine = scan(index, ids, raw, query_ids, queries, k)
                yield pa.record_batch([pa.array(query_ids[at_q]), pa.array(ids[at_x]), pa.array(cosine)],
                                      names=["query_id", "vec_id", "score"])

    found = (chunks.join(blocks, ["list", "salt"]).select("ids", "vectors", "query_ids", "queries")
             .mapInArrow(kernel, "query_id long, vec_id long, score double"))
    answers = (found.unionByName(vectors.where(is_query).mapInArrow(
        _sampled(index, k), "query_id long, vec_id long, score double"))
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


shipped(__name__)
