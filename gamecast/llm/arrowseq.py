"""Token ids as Arrow files of equal-length sequences.

The ids of all documents, in ascending document order, each document ended by an end id, are one long stream. It is
cut over files in the Arrow IPC file format: a record batch holds a fixed number of rows, and a row is one sequence as
two fixed-size lists, `ids` and `mask` (false: padding, only at the end of a file). All batches but a file's last are
equally large, so sequence k of a file is row ``k % rows`` of batch ``k // rows``; `SequenceFile` maps a file and
returns it without copying. Beside each file a second Arrow file lists its documents (doc_id, start, n_tokens), and a
manifest table says where in the whole stream each file begins.

Spark range-partitions the documents by id and writes one file for each partition while its rows stream by; offsets
come from a running sum over the manifest, one row a file. A task writes under a name of its own attempt and renames
it, so a task that runs again, or twice at once, leaves one whole file.

Defined cases: a very long text is encoded whole and flows over as many sequences as it needs; null texts are empty (only the end id); null ids come first; documents with equal ids are ordered by a
hash of the text, then the text; repeated rows all stay; an empty table gives no documents; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from gamecast.llm import tokenids
from gamecast.llm.common import shared_path, shipped, stored, text_or_empty

LENGTH, ROWS = 2048, 256
DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "part long, path string, docs_path string, n_docs long, n_tokens long"


def _schema(length: int, rows: int, dtype: np.dtype) -> pa.Schema:
    """Sequences of `length` ids with their masks, and what a reader has to know, as metadata."""
    kind = pa.from_numpy_dtype(dtype)
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))],
                     {"layout": json.dumps({"length": length, "rows": rows})})


def _sequences(ids: np.ndarray, n_real: int, schema: pa.Schema) -> pa.RecordBatch:
    length = schema.field("ids").type.list_size
    return pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(ids), length),
                            pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(ids)) < n_real), length)], schema=schema)


def write_sequences(documents: DataFrame, tokenizer: str, path: str | None = None, length: int = LENGTH,
                    rows: int = ROWS, end_id: int = 0, kind: type = tokenids.SpacedWordIds) -> DataFrame:
    """Write the files below `path` (a new one in the shared folder by default); returns their manifest.

    `tokenizer`: path of a tokenizers file. The manifest has `base`, the number of ids in the files before.
    """
    spark = documents.sparkSession
    path = path or shared_path(spark, "sequences")
    typecode, dtype = "H", np.dtype("<u2")
    schema, full = _schema(length, rows, dtype), length * rows

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenids.loaded(kind, tokenizer, typecode)
        end = words.packed([end_id])
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        fs, folder = pa.fs.FileSystem.from_uri(path)
        fs.create_dir(folder, recursive=True)
        names = [f"part-{part:06d}.arrow", f"part-{part:06d}.docs.arrow"]
        n_docs = n_tokens = 0
        left = np.empty(0, dtype)
        with (fs.open_output_stream(f"{folder}/.{attempt}-{names[0]}") as out,
              fs.open_output_stream(f"{folder}/.{attempt}-{names[1]}") as docs_out,
              pa.ipc.new_file(out, schema) as sequences, pa.ipc.new_file(docs_out, DOCS) as docs):
            for batch in batches:
                texts, done = batch.column("text"), 0
                coded: list[bytes] = []
                size = 0

                def flush(last: int) -> None:
                    nonlocal left, n_docs, n_tokens, done, size
                    lengths = np.array([len(c) // dtype.itemsize for c in coded], np.int64)
                    docs.write_batch(pa.record_batch(
                        [batch.column("doc_id").slice(done, len(coded)),
                         pa.array(n_tokens + np.cumsum(lengths) - lengths), pa.array(lengths)], schema=DOCS))
                    left = np.concatenate([left, np.frombuffer(b"".join(coded), dtype)])
                    whole = len(left) // full * full
                    for at in range(0, whole, full):
                        sequences.write_batch(_sequences(left[at:at + full], full, schema))
                    left = left[whole:].copy()
                    n_docs, n_tokens, done, size = n_docs + len(coded), n_tokens + int(lengths.sum()), last, 0
                    coded.clear()

                for k, ids in enumerate(tokenids.ids_of(words, (t.as_py() for t in texts))):
                    coded.append(ids + end)
                    size += len(ids)
                    if size >= 4 * full:
                        flush(k + 1)
                if coded:
                    flush(len(texts))
            if len(left):
                padded = np.zeros(-(-len(left) // length) * length, dtype)
                padded[:len(left)] = left
                sequences.write_batch(_sequences(padded, len(left), schema))
        for name in names:
            fs.move(f"{folder}/.{attempt}-{name}", f"{folder}/{name}")
        yield pa.record_batch([pa.array([v], t) for v, t in zip(
            (part, *(f"{path}/{n}" for n in names), n_docs, n_tokens),
            (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
            names=["part", "path", "docs_path", "n_docs", "n_tokens"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]     # the hash splits an id that many rows share
    written = docs.repartitionByRange(*order[:2]).sortWithinPartitions(*order).mapInArrow(kernel, MANIFEST)
    manifest = stored(written, "sequences-manifest")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)     # one row a file
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class SequenceFile:
    """Random access to one file's sequences; on a local path they are views of the mapped file."""

    def __init__(self, path: str):
        fs, name = pa.fs.FileSystem.from_uri(path)
        self.source = pa.memory_map(name) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(name)
        self.reader = pa.ipc.open_file(self.source)
        layout = json.loads(self.reader.schema.metadata[b"layout"])
        self.length, self.rows = layout["length"], layout["rows"]

    def sequence(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """(ids, mask) of sequence k."""
        batch, row = self.reader.get_batch(k // self.rows), k % self.rows
        ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
        return ids[row * self.length:(row + 1) * self.length], batch.column("mask")[row].values

    def stream(self) -> Iterator[np.ndarray]:
        """The file's ids without padding, a batch at a time."""
        for k in range(self.reader.num_record_batches):
            batch = self.reader.get_batch(k)
            ids, mask = batch.column("ids").flatten().to_numpy(zero_copy_only=True), batch.column("mask").flatten()
            yield ids if mask.true_count == len(ids) else ids[:mask.true_count]

    def close(self) -> None:
        self.reader = None
        self.source.close()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, docs_path, base in zip(*(batch.column(k).to_pylist() for k in ("path", "docs_path", "base"))):
            file = SequenceFile(path)
            fs, name = pa.fs.FileSystem.from_uri(docs_path)
            blocks, block = file.stream(), np.empty(0, np.uint16)
            with fs.open_input_file(name) as source:
                docs = pa.ipc.open_file(source)
                for k in range(docs.num_record_batches):
                    rows = docs.get_batch(k)
                    sums = []
                    for need in rows.column("n_tokens").to_pylist():
                        crc = 0
                        while need:
                            if not len(block):
                                block = next(blocks)
                            crc = zlib.crc32(block[:need].astype("<u4").tobytes(), crc)
                            need, block = need - min(need, len(block)), block[need:]
                        sums.append(crc)
                    start = pa.array(rows.column("start").to_numpy() + base)
                    yield pa.record_batch([rows.column("doc_id"), start, rows.column("n_tokens"),
                                           pa.array(sums, pa.int64())],
                                          names=["doc_id", "start", "n_tokens", "ids_crc32"])
            file.close()


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files; one task reads a few files."""
    n_files = max(1, manifest.count())
    return (manifest.select("path", "docs_path", "base").repartition(n_files)
            .mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


shipped(__name__)
