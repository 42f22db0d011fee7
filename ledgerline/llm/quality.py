"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are counted on the whole text where it lies. Training takes place on the driver, on at most about
MAX_TRAINING_ROWS labelled documents chosen by a hash of doc_id (the documented bound; of a doc_id's rows one, by a hash of
its text), for which alone statistics are gathered; everything else covers all rows. Trees are complete, flattened into
arrays of features, thresholds and leaf values, and traversed for all rows of a batch at once, level by level.

Labels, lang, source and doc_id are never inputs of a score. Null text counts as empty; equal texts get equal scores. Rows
whose label is null are unlabelled; several labels of one doc_id count by their mean (0.5 and more is 1). Without labelled
rows every score is 0.5, with labels of one kind only it is that kind's smoothed share. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import forget, materialise
from .text import BLOCK_BYTES, NOT_SPACE, buffers, slices, span_hashes, words

MAX_TRAINING_ROWS = 60_000
TREES, DEPTH, RATE, BINS, RIDGE, LEAST_WEIGHT = 150, 5, 0.1, 64, 1.0, 2.0

_CLASSES = {
    "upper": [(65, 90)],
    "lower": [(97, 122)],
    "digit": [(48, 57)],
    "newline": [(10, 10)],
    "loud": [(33, 33), (63, 63)],
    "symbol": [(35, 38), (42, 43), (64, 64), (94, 94), (126, 126)],
    "bar": [(124, 124), (60, 62), (91, 93), (123, 123), (125, 125), (95, 95)],
    "stop": [(46, 46)],
    "comma": [(44, 44), (58, 59)],
    "wide": [(128, 255)],
}
FEATURES = [
    "bytes", "words", "word_length", "word_length_spread", "longest_word", "short_words", *_CLASSES, "wide_upper", "upper_share", "capital_words", "upper_words", "odd_words",
    "distinct_words", "top_word", "distinct_triples", "lines", "line_length", "distinct_lines", "top_line",
]


def _per_doc(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[off])


def _repeats(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Share of distinct values and share of the commonest one, per document."""
    total = np.bincount(doc, minlength=n)
    h = h.copy()
    cuts = np.concatenate([[0], np.cumsum(total)]).tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    runs = np.diff(np.append(first, len(h)))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, doc[first], runs)
    safe = np.maximum(total, 1)
    return np.bincount(doc[first], minlength=n) / safe, top / safe


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The features of each document, as rows of float32."""
    n = len(off) - 1
    size = np.diff(off)
    safe = np.maximum(size, 1)
    out: dict[str, np.ndarray] = {"bytes": np.log1p(size)}
    masks = {}
    for name, parts in _CLASSES.items():
        t = np.zeros(256, bool)
        for a, b in parts:
            t[a : b + 1] = True
        masks[name] = t
        out[name] = _per_doc(t[data], off) / safe
    lead = np.zeros(len(data), bool)
    if len(data) > 1:
        lead[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    out["wide_upper"] = _per_doc(lead, off) / safe
    out["upper_share"] = (out["upper"] + out["wide_upper"]) / np.maximum(out["upper"] + out["wide_upper"] + out["lower"], 1e-9)
    s, e, doc = words(data, off, NOT_SPACE)
    count = np.bincount(doc, minlength=n)
    some = np.maximum(count, 1)
    length = (e - s).astype(np.float64)
    out["words"] = np.log1p(count)
    out["word_length"] = np.bincount(doc, weights=length, minlength=n) / some
    out["word_length_spread"] = np.sqrt(np.maximum(0, np.bincount(doc, weights=length**2, minlength=n) / some - out["word_length"] ** 2))
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    out["longest_word"] = np.log1p(longest)
    out["short_words"] = np.bincount(doc, weights=length <= 3, minlength=n) / some
    if len(s):
        letters = np.concatenate([[0], np.cumsum(masks["lower"][data] | (masks["wide"][data]))])
        capital = np.concatenate([[0], np.cumsum(masks["upper"][data])])
        odd = np.concatenate([[0], np.cumsum((masks["symbol"] | masks["loud"] | masks["bar"])[data])])
        has = lambda c: c[e] > c[s]
        begins = masks["upper"][data[s]]
        out["capital_words"] = np.bincount(doc, weights=begins, minlength=n) / some
        out["upper_words"] = np.bincount(doc, weights=has(capital) & ~has(letters) & (length > 1), minlength=n) / some
        out["odd_words"] = np.bincount(doc, weights=has(odd), minlength=n) / some
        h = span_hashes(data, s, e)
        out["distinct_words"], out["top_word"] = _repeats(h, doc, n)
        if len(h) > 2:
            whole = doc[:-2] == doc[2:]
            triple = h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
            out["distinct_triples"] = _repeats(triple[whole], doc[:-2][whole], n)[0]
    not_newline = ~masks["newline"]
    ls, le, ldoc = words(data, off, not_newline)
    lines = np.bincount(ldoc, minlength=n)
    out["lines"] = np.log1p(lines)
    out["line_length"] = np.log1p(np.bincount(ldoc, weights=le - ls, minlength=n) / np.maximum(lines, 1))
    if len(ls):
        out["distinct_lines"], out["top_line"] = _repeats(span_hashes(data, ls, le), ldoc, n)
    zero = np.zeros(n)
    return np.stack([out.get(f, zero) for f in FEATURES], axis=1).astype(np.float32)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, features (array<float>) and a hash of the text of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(1))
            for i, j in slices(off, BLOCK_BYTES):
                x = statistics(data[off[i] : off[j]], off[i : j + 1] - off[i])
                at = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.ListArray.from_arrays(pa.array(at), pa.array(x.reshape(-1))), batch.column(2)[i:j]], ["doc_id", "features", "digest"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("digest"))
    return source.mapInArrow(run, "doc_id long, features array<float>, digest long")


@dataclass
class Forest:
    """Complete trees in arrays: feature and threshold of inner nodes [tree, 2**depth - 1], leaf values [tree, 2**depth]."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row, all rows going down each tree level by level."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (len(leaf) - 1)]
        return 1 / (1 + np.exp(-total))


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Boost trees on the logistic loss, choosing splits from histograms of binned features."""
    inner, n_features = 2**depth - 1, x.shape[1] if x.ndim == 2 else len(FEATURES)
    positive = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    forest = Forest(float(np.log(positive / (1 - positive))), np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, inner + 1)))
    if not len(y) or y.min() == y.max():
        return forest
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for f in range(n_features)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(n_features)], axis=1)
    offset = np.arange(n_features) * BINS
    flat = (binned + offset).reshape(-1)
    total = np.full(len(y), forest.base)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            slot = np.repeat(node - first, n_features) * (n_features * BINS) + flat
            g = np.bincount(slot, np.repeat(grad, n_features), width * n_features * BINS).reshape(width, n_features, BINS)
            h = np.bincount(slot, np.repeat(hess, n_features), width * n_features * BINS).reshape(width, n_features, BINS)
            gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
            gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
            gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
            gain[(hl < LEAST_WEIGHT) | (ht - hl < LEAST_WEIGHT)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            split = np.zeros(width, np.int64)
            for k in range(width):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-6 and b < len(edges[f]):
                    feature[first + k], threshold[first + k], split[k] = f, edges[f][b], b
                else:
                    split[k] = BINS
            own = node - first
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > split[own])
        at = node - inner
        value = RATE * np.bincount(at, grad, inner + 1) / (np.bincount(at, hess, inner + 1) + RIDGE)
        total += value[at]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(value)
    return Forest(forest.base, np.array(features), np.array(thresholds), np.array(leaves))


def is_held_out() -> Column:
    """Rows whose crc32 of doc_id as text leaves 1 modulo 3 are never trained on."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Forest:
    """Train on the labelled documents that aren't held out; about `max_rows` of them, by hash, if there are more."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where("doc_id is not null and quality is not null").where(~is_held_out())
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    n = known.count()
    if n > max_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int((1 << 40) * (max_rows / n)))
    # The ids are bounded by max_rows, so they go to the texts; only texts with a label are looked at.
    ids = materialise(known, "quality-labels")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")
    one = document_statistics(chosen).groupBy("doc_id").agg(F.min_by("features", "digest").alias("features"))
    rows = one.join(ids, "doc_id").select("doc_id", "label", "features").toArrow().sort_by("doc_id")
    forget(ids)
    x = rows.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    return train(x, rows.column("label").to_numpy().astype(np.float64))


def score_of(text: Column, forest: Forest) -> Column:
    """The score of each text, which alone goes to Python and in blocks. The forest is a few hundred kB whatever the input."""

    def run(column: pa.Array) -> pa.Array:
        data, off = buffers(column)
        parts = [forest.score(statistics(data[off[i] : off[j]], off[i : j + 1] - off[i])) for i, j in slices(off, BLOCK_BYTES)]
        return pa.array(np.concatenate(parts) if parts else np.empty(0), pa.float64())

    return F.arrow_udf(run, "double")(text.cast("string"))


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted (1 if score >= 0.5)."""
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score_of(F.col("text"), fit(docs, labels, max_rows)).alias("score"))
    return out.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """The documents that the classifier accepts, with all their columns: these never leave the JVM."""
    return docs.where(score_of(F.col("text"), fit(docs, labels, max_rows)) >= 0.5)
