"""Documents packed in chunks, and the exchange of blobs between chunks and hash buckets.

Work on every position of a corpus would need a row per position in plain DataFrames. Here a row is a chunk of whole
documents (a few MB of text); a chunk sends each bucket one blob of packed arrays, a bucket answers each chunk with one
blob, and Spark moves the blobs. The chunk table is written bucketed by chunk, so answers come to the text and the text
itself never moves again. The number of buckets follows the measured bytes of text, as does the number of tasks that work
on them beyond spark.sql.shuffle.partitions, so a bucket and a task stay as large as they are whatever the corpus.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import ROW_GROUP_BYTES
from .text import buffers, slices

CHUNK_BYTES = 4 << 20
LAST_ID = (1 << 63) - 1  # stands for a null doc_id: larger than every other
BUCKETS_PER_PARTITION = 4
BUCKET_TEXT = 4 << 20  # bytes of text that a bucket answers for at most, on average
TASK_TEXT = 64 << 20  # of text whose buckets one task works on at most, on average
PLACE_BITS = 40  # a chunk's number is its partition and the row its first document has there, so chunk + place is a row's own


def framed(batch: pa.RecordBatch) -> bytes:
    """A record batch with its schema as bytes."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unframed(raw: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(raw).read_next_batch()


class Chunks:
    """A table of chunk (long), ids (array of doc_id), ends (offsets), text (bytes) and bytes (its length), bucketed by chunk.

    carry: also keep the documents' other columns (as `rest`), so that `rewritten` can give whole rows back.
    """

    def __init__(self, docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, carry: bool = False):
        self.spark, self.schema = docs.sparkSession, docs.schema
        self.partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"ledgerline_chunks_{uuid.uuid4().hex}"
        self.others = [c for c in docs.columns if c != "text"] if carry else []

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seq = TaskContext.get().partitionId() << PLACE_BITS
            for batch in batches:
                data, off = buffers(batch.column(1))
                ids = batch.column(0).fill_null(LAST_ID)
                rest = pa.RecordBatch.from_arrays(batch.columns[2:], batch.schema.names[2:]) if carry else None
                for i, j in slices(off, chunk_bytes):
                    own = off[i : j + 1] - off[i]
                    columns = [pa.array([seq]), pa.array([ids[i:j].to_pylist()], pa.list_(pa.int64())), pa.array([own.tolist()], pa.list_(pa.int64())), pa.array([data[off[i] : off[j]].tobytes()], pa.binary()), pa.array([int(own[-1])])]
                    if carry:
                        columns.append(pa.array([framed(rest.slice(i, j - i))], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, ["chunk", "ids", "ends", "text", "bytes", "rest"][: len(columns)])
                    seq += j - i

        source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(f"`{c}`").alias(f"rest{k}") for k, c in enumerate(self.others)], *([F.col("text").isNull().alias("no_text")] if carry else []))
        packed = source.mapInArrow(pack, "chunk long, ids array<long>, ends array<long>, text binary, bytes long" + (", rest binary" if carry else ""))
        packed.write.bucketBy(self.partitions, "chunk").option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).format("parquet").saveAsTable(self.name)
        size = self.table().agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
        self.buckets = max(self.partitions * BUCKETS_PER_PARTITION, -(-size // BUCKET_TEXT))
        self.tasks = -(-size // TASK_TEXT)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def each(self, work: Callable, schema: str) -> DataFrame:
        """work(chunk, ids, ends, text) of every chunk yields record batches of `schema`."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    yield from work(*opened(batch, k))

        return self.table().mapInArrow(run, schema)

    def gathered(self, blobs: DataFrame, work: Callable, schema: str) -> DataFrame:
        """work(table of one bucket's rows) -> table, for each bucket. A bucket holds a bounded share of all positions."""
        if self.tasks > self.partitions:
            blobs = blobs.repartition(self.tasks, "bucket")
        return blobs.groupBy("bucket").applyInArrow(work, schema)

    def rewritten(self, answers: DataFrame, work: Callable) -> DataFrame:
        """The documents' rows again: work(chunk, ids, ends, text, answers) says which places stay and what their texts are.

        It returns (mask or None for all, columns by name that take the place of the documents' own). Rows whose text is
        null keep what they have.
        """
        names = [f.name for f in self.schema.fields]
        others = self.others

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            out = []
            for batch in left.to_batches():
                for k in range(batch.num_rows):
                    rest = unframed(batch.column(batch.schema.get_field_index("rest"))[k].as_py())
                    opening = opened(batch, k)
                    mask, fresh = work(*opening, right)
                    if "text" not in fresh:
                        raw, ends = opening[3].tobytes(), opening[2].tolist()
                        fresh["text"] = pa.array([raw[a:b].decode("utf-8") for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())
                    none = rest.column(len(others))
                    of = {n: rest.column(i) for i, n in enumerate(others)}
                    new = {n: pc.if_else(none, of[n], c.cast(of[n].type)) if n in of else pc.if_else(none, pa.scalar(None, c.type), c) for n, c in fresh.items() if n in names}
                    columns = [new[n] if n in new else of[n] for n in names]
                    whole = pa.RecordBatch.from_arrays(columns, names)
                    out.append(whole if mask is None else whole.filter(pa.array(mask)))
            return pa.Table.from_batches(out) if out else pa.table({})

        return self.table().groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, self.schema)

    def answered(self, answers: DataFrame, work: Callable, schema: str) -> DataFrame:
        """work(chunk, ids, ends, text, answers) of every chunk with all rows of `answers` for it, as one table."""
        kinds = _arrow_schema(schema)

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            out = []
            for batch in left.to_batches():
                for k in range(batch.num_rows):
                    out += work(*opened(batch, k), right)
            return pa.Table.from_batches(out, kinds)

        return self.table().groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)


def opened(batch: pa.RecordBatch, k: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    c = {n: batch.column(batch.schema.get_field_index(n)) for n in ("chunk", "ids", "ends", "text")}
    text = np.frombuffer(c["text"][k].as_buffer(), np.uint8)
    return c["chunk"][k].as_py(), c["ids"][k].values.to_numpy(zero_copy_only=False), c["ends"][k].values.to_numpy(zero_copy_only=False), text


def _arrow_schema(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays end to end behind a head of their types and lengths; integers in the fewest bytes above their minimum."""
    head, parts = [], []
    for a in arrays:
        low = 0
        if a.dtype == np.int64 and len(a):
            least = int(a.min())
            spread = int(a.max()) - least
            if spread < 1 << 32:
                low = least
                a = (a - low).astype(np.uint8 if spread < 1 << 8 else np.uint16 if spread < 1 << 16 else np.uint32)
        head.append(f"{a.dtype.str}:{len(a)}:{low}")
        parts.append(a.tobytes())
    return (",".join(head) + "\n").encode() + b"".join(parts)


def unpack(blob: bytes) -> list[np.ndarray]:
    end = blob.index(b"\n")
    out, at = [], end + 1
    for part in blob[:end].decode().split(","):
        kind, n, low = part.split(":")
        a = np.frombuffer(blob, np.dtype(kind), int(n), at)
        at += a.nbytes
        if low != "0":
            a = a.astype(np.int64) + int(low)
        out.append(a)
    return out
