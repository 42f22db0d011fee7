"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

A document holds a benchmark item when it has at least `percent` / 100 of the item's distinct five-word shingles, wherever
they stand. Items are partitioned by the power of two of their number of shingles. Each partition is an index of its own,
over the bottom-k MinHash sketches of its items, with k = u - ceil(u * percent / 100) + 1 for items of up to u shingles. A
document that lacks all k of an item's sketch lacks too much of it, so the search has recall 1, and short items are found in
documents of any length, which a Jaccard threshold would lose. A document skips the partitions whose items it is too small to
hold; in the others all its shingles are looked up, where it lies. Hits are verified on the words.

Words are runs of ASCII letters, digits and all characters above ASCII, lower-cased (A-Z): punctuation, white space and
case don't hide a passage. Items of fewer than five words have their whole word sequence as their one shingle, looked up
among the document's sequences of that length; items without words are never held.

Sketches are made on the executors. The index is broadcast in blocks of at most about INDEX_BYTES, whose number follows from
the measured size of the benchmark; each block is one more scan of the documents. Each row is judged by its own text. Null
texts are empty; a null item_id is kept as null; repeated items count once. Extra columns are kept by `clean`, and ignored
else.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import forget, materialise
from .text import ALNUM, BLOCK_BYTES, U64, buffers, shingles, slices

SIZE = 5
PERCENT = 80
INDEX_BYTES = 32 << 20  # of sketches and item texts that are broadcast at once

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")
FOUND = "array<struct<item_id:bigint,containment:double>>"


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(_UPPER))


def word_shingles(found: list[str], size: int) -> set[tuple[str, ...]]:
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def needed(n: int, percent: int) -> int:
    """Shingles of an item of n that a document must have."""
    return -(-n * percent // 100)


def sketches(benchmark: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """item_id, text, width (words of a shingle), n (shingles), part (largest size of its partition) and sketch of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                width = min(size, len(words(text)))
                if not width:
                    continue
                h, _ = shingles(*buffers(pa.array([text])), width, ALNUM)
                n = len(h)
                part = 1 << (n - 1).bit_length()
                rows.append((item_id, text, width, n, part, h[: part - needed(part, percent) + 1].tobytes()))
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["item_id", "text", "width", "n", "part", "sketch"])

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    return items.mapInArrow(run, "item_id long, text string, width int, n int, part int, sketch binary")


class Partition:
    """The sketches of items of one shingle width and size class: sorted hashes, and the item of each."""

    def __init__(self, smallest: int, hashes: np.ndarray, items: np.ndarray, percent: int):
        self.least = needed(smallest, percent)  # shingles of a document that can hold any of them
        order = np.argsort(hashes, kind="stable")
        self.keys, self.items = hashes[order], items[order]
        self.bits = max(10, (8 * len(hashes)).bit_length())
        self.some = np.zeros(1 << self.bits, bool)
        self.some[self._slot(hashes)] = True

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> U64(64 - self.bits)).astype(np.int64)

    def probe(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of h whose hash is in a sketch, and the range of its entries."""
        at = np.flatnonzero(self.some[self._slot(h)])
        low, high = np.searchsorted(self.keys, h[at]), np.searchsorted(self.keys, h[at], side="right")
        hit = low < high
        return at[hit], low[hit], high[hit]


class Index:
    """The partitions of a block of items, prepared once and sent to all tasks."""

    def __init__(self, table: pa.Table, percent: int):
        self.percent = percent
        self.ids, self.texts = table.column("item_id").to_pylist(), table.column("text").to_pylist()
        self.widths = table.column("width").to_numpy()
        n, part = table.column("n").to_numpy(), table.column("part").to_numpy()
        sketch = [np.frombuffer(x, U64) for x in table.column("sketch").to_pylist()]
        self.partitions: dict[int, list[Partition]] = {}
        for width, top in sorted(set(zip(self.widths.tolist(), part.tolist(), strict=True))):
            own = np.flatnonzero((self.widths == width) & (part == top))
            hashes = [sketch[k] for k in own.tolist()]
            made = Partition(int(n[own].min()), np.concatenate(hashes), np.repeat(own, [len(x) for x in hashes]), percent)
            self.partitions.setdefault(width, []).append(made)

    def candidates(self, data: np.ndarray, off: np.ndarray) -> dict[int, set[int]]:
        """Items of whose sketch a document has a hash, for each such document."""
        out: dict[int, set[int]] = {}
        for width, partitions in self.partitions.items():
            h, doc = shingles(data, off, width, ALNUM, whole_short=False)
            size = np.bincount(doc, minlength=len(off) - 1)
            for p in partitions:
                large = size[doc] >= p.least
                own, of = (h, doc) if large.all() else (h[large], doc[large])
                for at, low, high in zip(*(x.tolist() for x in p.probe(own)), strict=True):
                    out.setdefault(int(of[at]), set()).update(p.items[low:high].tolist())
        return out

    def held(self, text: str, items: set[int]) -> list[tuple[int | None, float]]:
        """Items that the text holds, with the share of their shingles that it has."""
        found = words(text)
        grams: dict[int, set] = {}
        out = []
        for k in sorted(items):
            width = int(self.widths[k])
            if width not in grams:
                grams[width] = word_shingles(found, width)
            wanted = word_shingles(words(self.texts[k]), width)
            n = len(wanted & grams[width])
            if 100 * n >= self.percent * len(wanted):
                out.append((self.ids[k], n / len(wanted)))
        return out

    def found(self, column: pa.Array) -> pa.Array:
        data, off = buffers(column)
        out: list[list[dict]] = [[] for _ in range(len(column))]
        for i, j in slices(off, BLOCK_BYTES):
            for k, maybe in self.candidates(data[off[i] : off[j]], off[i : j + 1] - off[i]).items():
                text = data[off[i + k] : off[i + k + 1]].tobytes().decode("utf-8")
                out[i + k] = [{"item_id": a, "containment": b} for a, b in self.held(text, maybe)]
        return pa.array(out, pa.list_(pa.struct([("item_id", pa.int64()), ("containment", pa.float64())])))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def with_found(docs: DataFrame, benchmark: DataFrame, size: int, percent: int) -> tuple[DataFrame, str]:
    """`docs` with a column of the items that each row holds (FOUND; an empty array for none), and that column's name."""
    spark = docs.sparkSession
    table = materialise(sketches(benchmark, size, percent), "benchmark-sketches")
    total = table.agg(F.coalesce(F.sum(F.octet_length("sketch") + F.octet_length("text") + 100), F.lit(0))).first()[0]
    blocks = -(-total // INDEX_BYTES)
    name = free_name(docs, "found_items")

    def block(k: int):
        own = table.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        sent = spark.sparkContext.broadcast(Index(own.toArrow(), percent))

        def run(column: pa.Array) -> pa.Array:
            return sent.value.found(column)

        return F.arrow_udf(run, FOUND)(F.col("text").cast("string"))

    if blocks < 2:
        out = docs.withColumn(name, block(0) if blocks else F.array().cast(FOUND))
        forget(table)
        return out, name
    row = free_name(docs, "row_number")
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "benchmark-rows")
    parts = [rows.select(row, F.explode(block(k)).alias(name)) for k in range(blocks)]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.union(p)
    lists = materialise(merged.groupBy(row).agg(F.collect_list(name).alias(name)), "benchmark-found")
    forget(table)
    return rows.join(lists, row, "left").withColumn(name, F.coalesce(name, F.array().cast(FOUND))).drop(row), name


def hits(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """A row per row of `docs` and item that it holds: doc_id, item_id, containment."""
    rows, name = with_found(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, size, percent)
    return rows.select("doc_id", F.explode(name).alias("x")).select("doc_id", "x.item_id", "x.containment")


def report(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """A row per row of `docs`: doc_id, contaminated, item_ids (sorted, distinct), containment (the largest, 0 if none)."""
    rows, name = with_found(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, size, percent)
    part = lambda field: F.transform(name, lambda x: x[field])
    return rows.select(
        "doc_id", (F.size(name) > 0).alias("contaminated"), F.array_sort(F.array_distinct(F.array_compact(part("item_id")))).alias("item_ids"), F.coalesce(F.array_max(part("containment")), F.lit(0.0)).alias("containment")
    )


def clean(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The rows that hold no item, with all their columns."""
    rows, name = with_found(docs, benchmark, size, percent)
    return rows.where(F.size(name) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
