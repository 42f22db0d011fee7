"""N-gram Jaccard self-join by T-occurrence search (DivideSkip), with the components of its links.

Two documents link when their sets of distinct word shingles have a Jaccard similarity of `percent` / 100 or more,
decided in whole numbers. The search keeps, for a document of n shingles, the documents that share at least T = n *
percent / 100 of them: inverted lists are divided in long ones, which are only probed by binary search, and short ones,
which are merged by a heap; a candidate must stand T - L times in the short lists when L lists are long.

Over a corpus this takes place in three rounds, each linear in the text:

1. Documents of equal sets are one class; the one with the smallest doc_id stands for it. Chunks send the hashes of their
   shingles to buckets, which answer with each shingle's document frequency (its power of two). Shingles that no other
   class has can't be shared, so a document with fewer than T others has no link. For the rest, all but T - 1 of the
   others - the rarest - are the short lists: linked documents share at least one of those.
2. Groups by two min-hashes of the short lists find most links and join near copies to components. A large group is dealt
   over blocks by a salt; blocks meet through the other min-hash.
3. Every short list that still holds several components is searched as a whole, in groups that cover such lists. Large ones
   are split by the logarithm of the sets' sizes (linked sets are at most one step apart), and what is still large is
   searched by pairs of blocks. So no link between components is lost, and within a component nothing is compared any more.

`join` gives the components, `links` all links between classes, `one_of_each` the rows that stand for their components.

The nodes of both searches are classes, numbered by the row (chunk + place) that stands for them, whatever its doc_id is.
Only at the end are components put together whose rows share a doc_id, and named by their smallest doc_id.

Sets are compared by 64-bit shingle hashes. Null text is empty; an empty set links with nothing; a null doc_id counts as
larger than any other; rows with one doc_id are one document to the components of `join`. Extra columns are ignored.
Joins by a key that many rows may share deal those rows by a salt; the rows of one class meet its component in a join
that the adaptive engine splits.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import LAST_ID, Chunks, pack, unpack
from .components import components
from .storage import forget, materialise
from .text import BLOCK_BYTES, U64, mix, shingles, slices

SIZE = 4
PERCENT = 85
GROUP = 256  # documents searched in one block
SALTS = 16  # tasks that a hot key's rows are dealt over in a join
LONG_LIST_COST = 0.005  # DivideSkip's mu: what a probe of a long list costs against a step of the heap


def overlap_needed(n: int, percent: int) -> int:
    """Shingles that a set of n must share with any set that it links to."""
    return -(-percent * n // 100)


class InvertedIndex:
    """Inverted lists of a group of sets (sorted arrays of distinct hashes).

    labels: a component number of each set. A list whose sets are all of one component can't bring a link between
    components; it stays out, and so do lists of one set.
    """

    def __init__(self, sets: list[np.ndarray], labels: list[int] | None = None):
        self.sizes = [len(s) for s in sets]
        doc = np.repeat(np.arange(len(sets)), self.sizes)
        every = np.concatenate(sets) if sets else np.empty(0, U64)
        order = np.argsort(every, kind="stable")
        keys, docs = every[order], doc[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        label = np.asarray(labels if labels is not None else np.arange(len(sets)), np.int64)[docs]
        mixed = np.minimum.reduceat(label, first) != np.maximum.reduceat(label, first) if len(first) else np.empty(0, bool)
        ends = np.append(first[1:], len(keys))
        self._docs, self._first, self._ends = docs, first, ends
        # Lists by document: the numbers of its mixed lists.
        number = np.cumsum(new) - 1
        useful = mixed[number]
        by_doc = np.argsort(docs[useful], kind="stable")
        self._of = number[useful][by_doc]
        self._at = np.searchsorted(docs[useful][by_doc], np.arange(len(sets) + 1))

    def number_of_lists(self, q: int) -> int:
        return int(self._at[q + 1] - self._at[q])

    def lists(self, q: int) -> list[list[int]]:
        """q's lists, longest first."""
        own = self._of[self._at[q] : self._at[q + 1]]
        a, b = self._first[own], self._ends[own]
        order = np.argsort(a - b, kind="stable")
        return [self._docs[x:y].tolist() for x, y in zip(a[order].tolist(), b[order].tolist(), strict=True)]

    def search(self, q: int, needed: int, mu: float = LONG_LIST_COST) -> dict[int, int]:
        """DivideSkip: documents that stand in at least `needed` of q's lists, with their number of lists."""
        if self.number_of_lists(q) < max(1, needed):
            return {}
        lists = self.lists(q)
        longest = max(2, len(lists[0]))
        n_long = max(0, min(needed - 1, int(needed / (mu * np.log2(longest) + 1))))
        long, short = lists[:n_long], lists[n_long:]
        # Heap merge of the short lists, counting equal heads.
        found: dict[int, int] = {}
        least = needed - n_long
        heads = [(ids[0], k) for k, ids in enumerate(short)]
        heapq.heapify(heads)
        step = [0] * len(short)
        while heads:
            doc, count = heads[0][0], 0
            while heads and heads[0][0] == doc:
                k = heads[0][1]
                count += 1
                step[k] += 1
                if step[k] < len(short[k]):
                    heapq.heapreplace(heads, (short[k][step[k]], k))
                else:
                    heapq.heappop(heads)
            if count >= least and doc != q:
                found[doc] = count
        # Binary probes of the long lists, longest first, as long as the candidate can still reach the number.
        out = {}
        for doc, count in found.items():
            left = n_long
            for ids in long:
                if count + left < needed:
                    break
                left -= 1
                i = bisect_left(ids, doc)
                if i < len(ids) and ids[i] == doc:
                    count += 1
            if count >= needed:
                out[doc] = count
        return out


def linked(a: int, b: int, shared: int, percent: int) -> bool:
    return shared > 0 and 100 * shared >= percent * (a + b - shared)


def every_link(sets: list[np.ndarray], percent: int) -> list[tuple[int, int, int]]:
    """All links of a group: two places, the smaller one first, and the number of shared shingles."""
    index = InvertedIndex(sets)
    found = ((q, doc, shared) for q in range(len(sets)) for doc, shared in index.search(q, overlap_needed(index.sizes[q], percent)).items() if index.sizes[q])
    return [(q, doc, shared) for q, doc, shared in found if q < doc and linked(index.sizes[q], index.sizes[doc], shared, percent)]


def join_group(sets: list[np.ndarray], joined: list[int], percent: int) -> list[tuple[int, int]]:
    """New links that connect documents of different components; stops once there is one component.

    joined: a component number of each document, equal where already connected.
    """
    root = {}
    parent = list(range(len(sets)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left = 0
    for k, c in enumerate(joined):
        if c in root:
            parent[k] = root[c]
        else:
            root[c] = k
            left += 1
    out: list[tuple[int, int]] = []
    if left < 2:
        return out
    index = InvertedIndex(sets, joined)
    for q in range(len(sets)):
        if left < 2:
            break
        n = index.sizes[q]
        if not n:
            continue
        for doc, shared in index.search(q, overlap_needed(n, percent)).items():
            a, b = top(q), top(doc)
            if a != b and linked(n, index.sizes[doc], shared, percent):
                parent[max(a, b)] = min(a, b)
                out.append((q, doc))
                left -= 1
    return out


def _signature(h: np.ndarray) -> tuple[int, int]:
    a = np.bitwise_xor.reduce(mix(h)) if len(h) else U64(0)
    b = np.add.reduce(mix(h ^ U64(0x5851F42D4C957F2D))) if len(h) else U64(0)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _sets(text: np.ndarray, off: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each document's number and sorted distinct shingle hashes."""
    for i, j in slices(off, BLOCK_BYTES):
        h, d = shingles(text[off[i] : off[j]], off[i : j + 1] - off[i], size)
        cuts = np.searchsorted(d, np.arange(j - i + 1))
        for k in range(j - i):
            yield i + k, h[cuts[k] : cuts[k + 1]]


CLASS = "chunk long, place long, doc_id long, n_shingles long, sig_a long, sig_b long"


def _classes(size: int):
    def work(chunk: int, ids: np.ndarray, off: np.ndarray, text: np.ndarray) -> Iterator[pa.RecordBatch]:
        n, a, b = [], [], []
        for _, h in _sets(text, off, size):
            n.append(len(h))
            x, y = _signature(h)
            a.append(x)
            b.append(y)
        columns = [np.full(len(ids), chunk), np.arange(len(ids)), ids, n, a, b]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [f.split()[0] for f in CLASS.split(", ")])

    return work


class _Chosen:
    """A chunk's shingles of the documents that stand for their classes, distinct and in a fixed order by bucket."""

    def __init__(self, off: np.ndarray, text: np.ndarray, chosen: np.ndarray, buckets: int, size: int):
        wanted = np.zeros(len(off) - 1, bool)
        wanted[chosen] = True
        docs, parts = [], []
        for k, h in _sets(text, off, size):
            if wanted[k]:
                docs.append(k)
                parts.append(h)
        self.docs, self.at = docs, np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        self.hashes = np.concatenate(parts) if parts else np.empty(0, U64)
        # The order of buckets is that of the low bits' remainder; within one, 24 bits tell shingles apart.
        bucket = self.hashes % U64(buckets)
        key = bucket << U64(24) | self.hashes >> U64(40)
        self.keys, self.of = np.unique(key, return_inverse=True)
        self.counts = np.bincount(self.of, minlength=len(self.keys))
        self.cuts = np.searchsorted(self.keys, np.arange(buckets + 1, dtype=U64) << U64(24)).tolist()


def _chosen(answers: pa.Table) -> np.ndarray:
    places = [p for kind, p in zip(answers.column("kind").to_pylist(), answers.column("places").to_pylist(), strict=True) if kind == "chosen"]
    return np.array(places[0] if places else [], np.int64)


def _frequency_blobs(buckets: int, size: int):
    def work(chunk: int, ids: np.ndarray, off: np.ndarray, text: np.ndarray, answers: pa.Table) -> list[pa.RecordBatch]:
        c = _Chosen(off, text, _chosen(answers), buckets, size)
        low = (c.keys & U64(0xFFFFFF)).astype(np.uint32)
        planes = [((low >> np.uint32(8 * k)) & np.uint32(255)).astype(np.uint8) for k in (2, 1, 0)]
        count = np.minimum(c.counts, 255).astype(np.uint8)
        rows = [(b, pack(*(p[x:y] for p in planes), count[x:y])) for b, (x, y) in enumerate(zip(c.cuts[:-1], c.cuts[1:], strict=True)) if x < y]
        return [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([chunk] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "chunk", "blob"])]

    return work


def _frequencies(table: pa.Table) -> pa.Table:
    """The power of two under each shingle's document frequency, two to a byte: 1 for one document, at most 15."""
    parts = [unpack(b) for b in table.column("blob").to_pylist()]
    keys = np.concatenate([p[0].astype(np.int64) << 16 | p[1].astype(np.int64) << 8 | p[2] for p in parts])
    count = np.concatenate([p[3].astype(np.int64) for p in parts])
    _, back = np.unique(keys, return_inverse=True)
    level = np.minimum(15, np.log2(np.bincount(back, weights=count)).astype(np.int64) + 1).astype(np.uint8)[back]
    blobs, at = [], 0
    for p in parts:
        own = level[at : at + len(p[0])]
        at += len(p[0])
        if len(own) % 2:
            own = np.append(own, np.uint8(0))
        blobs.append((own[::2] << 4 | own[1::2]).tobytes())
    n = len(blobs)
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "kind": pa.array(["levels"] * n), "blob": pa.array(blobs, pa.binary()), "places": pa.array([None] * n, pa.list_(pa.int64()))})


ANSWER = "chunk long, bucket long, kind string, blob binary, places array<long>"
CANDIDATE = "node long, key_a long, key_b long, step long, short array<long>, shingles binary"


def size_step(n: int, percent: int) -> int:
    """The size's place on a logarithmic scale: sets that link are at most one step apart."""
    return n if percent >= 100 else int(math.log(n) / (math.log(100 / percent) * (1 + 1e-9)))


def _candidates(buckets: int, size: int, percent: int):
    def work(chunk: int, ids: np.ndarray, off: np.ndarray, text: np.ndarray, answers: pa.Table) -> list[pa.RecordBatch]:
        c = _Chosen(off, text, _chosen(answers), buckets, size)
        level = np.ones(len(c.keys), np.uint8)
        for bucket, kind, blob in zip(answers.column("bucket").to_pylist(), answers.column("kind").to_pylist(), answers.column("blob").to_pylist(), strict=True):
            if kind == "levels":
                x = np.frombuffer(blob, np.uint8)
                a, b = c.cuts[bucket], c.cuts[bucket + 1]
                level[a:b] = np.stack([x >> 4, x & 15], axis=1).reshape(-1)[: b - a]
        level = level[c.of]
        shared = np.concatenate([[0], np.cumsum(level > 1)])
        rows = []
        for k, a, b in zip(c.docs, c.at[:-1].tolist(), c.at[1:].tolist(), strict=True):
            needed = overlap_needed(b - a, percent)
            common = int(shared[b] - shared[a])
            if not needed or common < needed:
                continue
            every, lv = c.hashes[a:b], level[a:b]
            h, lv = every[lv > 1], lv[lv > 1]
            short = h[np.lexsort((h, lv))[: common - needed + 1]]
            other = mix(short ^ U64(0x2545F4914F6CDD1D))
            rows.append((chunk + k, int(short.min().astype(np.int64)), int(other.min().astype(np.int64)), size_step(b - a, percent), short.astype(np.int64), every.tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        columns = list(zip(*rows, strict=True)) or [()] * 6
        return [pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], [f.split()[0] for f in CANDIDATE.split(", ")])]

    return work


def _members(group: pa.Table) -> tuple[pa.Table, list[np.ndarray]]:
    """One row per class - pairs of blocks may bring one twice - and the shingles of each."""
    _, first = np.unique(group.column("node").to_numpy(), return_index=True)
    group = group.take(pa.array(first))
    return group, [np.frombuffer(x, U64) for x in group.column("shingles").to_pylist()]


def _linker(percent: int):
    def work(group: pa.Table) -> pa.Table:
        group, sets = _members(group)
        known = group.column("component").to_pylist()
        out = join_group(sets, known, percent)
        return pa.table({"a": pa.array([known[x] for x, _ in out], pa.int64()), "b": pa.array([known[y] for _, y in out], pa.int64())})

    return work


def _every_linker(percent: int):
    def work(group: pa.Table) -> pa.Table:
        group, sets = _members(group)
        nodes = group.column("node").to_pylist()
        out = every_link(sets, percent)
        return pa.table({"a": pa.array([nodes[x] for x, _, _ in out], pa.int64()), "b": pa.array([nodes[y] for _, y, _ in out], pa.int64()), "shared": pa.array([n for _, _, n in out], pa.int64())})

    return work


def _looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """`rows` (with node) joined with `table` by `key`; a hot key's rows are dealt over SALTS tasks."""
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salted, [key, "_salt"]).drop("_salt")


def _blocks(members: DataFrame, group: int) -> DataFrame:
    """Deal each key's members over salted blocks of about `group`."""
    counts = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    salt = F.pmod(F.xxhash64("node", "key"), F.ceil(F.col("n") / group))
    return _looked_up(members, counts, "key").select("key", F.lit(0).cast("long").alias("step"), salt.cast("int").alias("i"), F.lit(0).alias("j"), "node")


def _block_pairs(members: DataFrame, group: int) -> DataFrame:
    """Deal each key's members so that every two that may link meet. members: key, node, step.

    A small group is one block. A large one has a part for each size step, with the members of that step and the one
    below, and a part that is still large is dealt over all pairs of its blocks.
    """
    counts = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    sized = _looked_up(members, counts, "key")
    small = sized.where(F.col("n") <= group).select("key", F.lit(-1).cast("long").alias("step"), F.lit(0).alias("i"), F.lit(0).alias("j"), "node")
    parts = sized.where(F.col("n") > group).select("key", "node", F.col("step").alias("own_step"), F.explode(F.array("step", F.col("step") + 1)).alias("step"))
    # A part that only has members of the step below is searched there.
    part_counts = parts.groupBy("key", "step").agg(F.count("*").alias("n"), F.max("own_step").alias("top")).where("n > 1 and top = step")
    half = max(1, group // 2)
    named = parts.select("node", F.struct("key", "step").alias("part"))
    dealt = _looked_up(named, part_counts.select(F.struct("key", "step").alias("part"), "n"), "part")
    dealt = dealt.withColumn("blocks", F.when(F.col("n") <= group, 1).otherwise(F.ceil(F.col("n") / half)).cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    large = dealt.select("part.key", "part.step", "node", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return small.unionByName(large.select("key", "step", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node"))


def _search(dealt: DataFrame, sets: DataFrame, linker, schema: str) -> DataFrame:
    """What `linker` finds in each block. sets: node, component, shingles; only the blocks' members carry them."""
    # Few bytes can be much work here: the number of tasks is set, not derived from sizes.
    tasks = 2 * int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = dealt.join(sets, "node").select("key", "step", "i", "j", "node", "component", "shingles").repartition(tasks, "key", "step", "i", "j")
    return rows.groupBy("key", "step", "i", "j").applyInArrow(linker, schema)


def _covering_groups(lists: DataFrame) -> DataFrame:
    """key, node, step: groups that hold every list as a whole, most of them once. lists: elem, n, node, step.

    Each document names its longest list; a list joins the longest one that its documents name, and a group is all
    documents of the lists that joined. Lists of one group of near copies differ little, so they end up together.
    """
    named = lists.groupBy("node").agg(F.max(F.struct("n", "elem")).alias("longest"))
    target = lists.join(named, "node").groupBy("elem").agg(F.max("longest").alias("target"))
    return _looked_up(lists, target, "elem").select(F.col("target.elem").alias("key"), "node", "step").distinct()


def _wider(rows: DataFrame, links: DataFrame) -> DataFrame:
    """`rows` with the components that `links` (a, b: components) put together as one."""
    if links.isEmpty():
        return rows
    wider = components(links).select(F.col("node").alias("component"), F.col("component").alias("wider"))
    return rows.join(wider, "component", "left").withColumn("component", F.coalesce("wider", "component")).drop("wider")


def _candidate_sets(chunks: Chunks, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Round 1: rows (CLASS), classes (their signature and first row) and the candidates of round 2."""
    rows = materialise(chunks.each(_classes(size), CLASS), "ngram-sets")
    first = F.min(F.struct("doc_id", "chunk", "place")).alias("first")
    classes = materialise(rows.where("n_shingles > 0").groupBy("sig_a", "sig_b", "n_shingles").agg(first).select("sig_a", "sig_b", "n_shingles", "first.*"), "ngram-classes")
    chosen = classes.groupBy("chunk").agg(F.collect_list("place").alias("places")).select(
        "chunk", F.lit(-1).cast("long").alias("bucket"), F.lit("chosen").alias("kind"), F.lit(None).cast("binary").alias("blob"), "places"
    )
    blobs = chunks.answered(chosen, _frequency_blobs(chunks.buckets, size), "bucket long, chunk long, blob binary")
    answers = chunks.gathered(blobs, _frequencies, ANSWER).unionByName(chosen)
    found = materialise(chunks.answered(answers, _candidates(chunks.buckets, size, percent), CANDIDATE), "ngram-candidates")
    return rows, classes, found


def _labelled(classes: DataFrame, found: DataFrame, percent: int, group: int) -> DataFrame:
    """Rounds 2 and 3: the classes with their component, a written table."""
    apart = found.select("node", F.col("node").alias("component"), "shingles")
    both = found.select(F.col("key_a").alias("key"), "node").union(found.select(F.col("key_b").alias("key"), "node"))
    near = materialise(_search(_blocks(both, group), apart, _linker(percent), "a long, b long"), "ngram-links")
    made = components(near)
    joined = materialise(made, "ngram-components")
    forget(near, made)

    # What is left: short lists with several components, each set of documents once.
    known = found.select("node", "step", F.explode("short").alias("elem")).join(joined, "node", "left").select("node", "step", "elem", F.coalesce("component", "node").alias("component"))
    lists = known.groupBy("elem").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")
    )
    open_lists = lists.where("low < high").groupBy("n", "x", "y").agg(F.min("elem").alias("elem")).select("elem", "n")
    members = materialise(_looked_up(known, open_lists, "elem").select("elem", "n", "node", "step"), "ngram-open")
    labelled = found.select("node", "shingles").join(members.select("node").distinct(), "node").join(joined, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "shingles")
    far = materialise(_search(_block_pairs(_covering_groups(members), group), labelled, _linker(percent), "a long, b long"), "ngram-links")
    # A class takes the component of the row that stands for it, as the second search has joined it with others.
    labels = classes.withColumn("node", F.col("chunk") + F.col("place")).join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    out = materialise(_wider(labels, far), "ngram-labels")
    forget(members, far, joined)
    return out


def join(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, group: int = GROUP) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links, the document's own included)."""
    chunks = Chunks(docs)
    try:
        rows, classes, found = _candidate_sets(chunks, size, percent)
    finally:
        chunks.drop()
    labelled = _labelled(classes, found, percent, group)
    forget(found)
    sig = ["sig_a", "sig_b", "n_shingles"]
    sets = rows.where("n_shingles > 0")
    # Rows of one doc_id in different classes put their components together.
    held = materialise(sets.select(*sig, "doc_id").distinct().join(labelled.select(*sig, "component"), sig).select("doc_id", "component").distinct(), "ngram-held")
    shared = held.groupBy("doc_id").agg(F.min("component").alias("a"), F.max("component").alias("high")).where("a < high")
    same = materialise(held.join(shared, "doc_id").where("component > a").select("a", F.col("component").alias("b")), "ngram-links")
    labels = materialise(_wider(labelled.select(*sig, "doc_id", "component"), same), "ngram-named")
    # The row that stands for a class has its smallest doc_id.
    least = labels.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    full = sets.join(labels.join(least, "component").select(*sig, "component_id"), sig).select("doc_id", "n_shingles", "component_id")
    # An empty set has the component of the other rows of its doc_id, if there are any.
    none = rows.where("n_shingles = 0").select("doc_id", "n_shingles")
    by_id = _wider(held, same).join(least, "component").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = full.unionByName(none.join(by_id, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
    real = lambda c: F.when(F.col(c) != LAST_ID, F.col(c)).alias(c)
    result = materialise(out.select(real("doc_id"), "n_shingles", real("component_id")), "ngram-result")
    forget(rows, classes, labelled, held, same, labels)
    return result


def links(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """All links: (a, b, shared) between classes of equal sets, and the members (doc_id, class, n_shingles) of the classes.

    A class is named by the row that stands for it. The links of a group of near copies are as many as its pairs of classes;
    copies aren't expanded.
    """
    chunks = Chunks(docs)
    try:
        rows, classes, found = _candidate_sets(chunks, size, percent)
    finally:
        chunks.drop()
    known = found.select("node", "step", F.explode("short").alias("elem"))
    lists = known.groupBy("elem").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    several = lists.where("n > 1").groupBy("n", "x", "y").agg(F.min("elem").alias("elem")).select("elem", "n")
    members = materialise(_looked_up(known, several, "elem").select("elem", "n", "node", "step"), "ngram-lists")
    sets = found.select("node", F.col("node").alias("component"), "shingles")
    out = materialise(_search(_block_pairs(_covering_groups(members), group), sets, _every_linker(percent), "a long, b long, shared long").distinct(), "ngram-every-link")
    sig = ["sig_a", "sig_b", "n_shingles"]
    named = rows.where("n_shingles > 0").join(classes.select(*sig, (F.col("chunk") + F.col("place")).alias("class")), sig)
    member = materialise(named.select(F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")).alias("doc_id"), "class", "n_shingles"), "ngram-members")
    forget(rows, classes, found, members)
    return out, member


def one_of_each(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, group: int = GROUP) -> DataFrame:
    """The rows of `docs`, with all their columns, that stand for their components: the one of the smallest doc_id stays.

    Each row is a document of its own here, also where doc_ids are null (the largest) or repeated; of equal ones in a
    component the first row stays. Rows with an empty set all stay. Texts don't move: they are asked for by chunk.
    """
    chunks = Chunks(docs, carry=True)
    try:
        rows, classes, found = _candidate_sets(chunks, size, percent)
        labelled = _labelled(classes, found, percent, group)
        first = labelled.groupBy("component").agg(F.min(F.struct("doc_id", "chunk", "place")).alias("first")).select("first.chunk", "first.place")
        kept = first.union(rows.where("n_shingles = 0").select("chunk", "place")).groupBy("chunk").agg(F.collect_list("place").alias("places"))

        def work(chunk: int, ids: np.ndarray, off: np.ndarray, text: np.ndarray, answers: pa.Table) -> tuple[np.ndarray, dict]:
            mask = np.zeros(len(ids), bool)
            for places in answers.column("places").to_pylist():
                mask[places] = True
            return mask, {}

        out = materialise(chunks.rewritten(kept, work), "ngram-kept")
        forget(rows, classes, found, labelled)
        return out
    finally:
        chunks.drop()
