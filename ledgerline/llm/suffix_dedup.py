"""Exact substring dedup by a common-prefix-aware distributed merge sort of suffixes.

A byte goes if a `span`-byte string over it also starts in a document with a smaller doc_id.

Which suffixes are sorted. A `span`-byte window is anchored at its minimizer: the leftmost of its k-grams with the least
hash. That is a function of the window's bytes, so equal windows have equal anchors at equal distance. Neighbouring
windows of one anchor form one string of `span` to 2 * span - k bytes; every window is in exactly one string. Three rounds:

1. Chunks send the hashes of their anchors' k-grams to buckets, which answer which of them stand in several documents.
   Strings whose k-gram no other document has can't share a window and take no further part.
2. All others are sorted as suffixes: from the anchor on, up to the string's end. Each chunk sorts its distinct ones (told
   apart on their bytes), front-codes the run (length of the prefix shared with the one before, then the rest) and sends
   it; the bucket merges all runs with a loser tree whose entries carry the common prefix with the last winner, so known
   prefixes are never compared again. The merged order and its common prefixes give, for each distance to the left, the
   groups of equal windows, and the bytes left of the anchor split them. Windows that an earlier document has are marked
   in an answer to the owner's chunk.
3. Chunks turn the answers into byte ranges.

So every removal is decided on bytes; hashes only leave out what can't match. A common string is one row per chunk and
bucket, never a row per document. A k-gram with more than HOT_GRAM different strings is split: a window reaches at least
half of span - k beyond the k-gram on one side, so its strings are dealt once by the bytes right of it and once by the
bytes left of it, and each deal decides the windows that reach that far on its side.

Null text is empty, a null doc_id counts as larger than any other, documents with one doc_id don't remove from each other,
and texts shorter than the span stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .chunks import LAST_ID, Chunks, pack, unpack
from .storage import forget, materialise
from .text import BLOCK_BYTES, U64, mix, powers, ranges, slices

SPAN = 50
GRAM = 16


def _slide_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` neighbours."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return x if done == width else np.minimum(x[: len(x) - (width - done)], x[width - done :])


def anchored(data: np.ndarray, off: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchor, first and last window start, hash of the anchor's k-gram, hash of the string, document: of each string."""
    none = np.empty(0, np.int64)
    n = len(data)
    if n < span or not (np.diff(off) >= span).any():
        return none, none, none, none.astype(U64), none.astype(U64), none
    power, inverse = powers(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * power[:n], out=sums[1:])
    gram_hash = mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
    key = (gram_hash & U64(0xFFFFFFFF00000000)) | np.arange(len(gram_hash), dtype=U64)
    at = (_slide_min(key, span - gram + 1) & U64(0xFFFFFFFF)).astype(np.int64)
    del key
    # Windows may not cross a document's end.
    edge = np.zeros(len(at) + 1, np.int32)
    inner = off[1:-1]
    np.add.at(edge, np.clip(inner - span + 1, 0, len(at)), 1)
    np.add.at(edge, np.clip(inner, 0, len(at)), -1)
    inside = np.cumsum(edge[:-1]) == 0
    fresh = inside.copy()
    fresh[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= (at[1:] != at[:-1]) | ~inside[1:]
    p0, p1 = np.flatnonzero(fresh), np.flatnonzero(ends)
    q = at[p0]
    stop = p1 + span
    whole = mix((sums[stop] - sums[p0]) * inverse[p0] + (stop - p0).astype(U64))
    return q, p0, p1, gram_hash[q], whole, np.searchsorted(off, p0, side="right") - 1


class Strings:
    """A chunk's strings, and the distinct k-grams of their anchors by bucket and hash."""

    def __init__(self, ids: np.ndarray, off: np.ndarray, text: np.ndarray, buckets: int, span: int, gram: int):
        parts = []
        for i, j in slices(off, BLOCK_BYTES):
            q, p0, p1, g, h, d = anchored(text[off[i] : off[j]], off[i : j + 1] - off[i], span, gram)
            parts.append((q + off[i], p0 + off[i], p1 + off[i], g, h, d + i))
        self.q, self.p0, self.p1, g, self.hash, doc = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.empty(0, np.int64),) * 6
        g, self.hash = g.astype(U64), self.hash.astype(U64)
        self.owner = ids[doc] if len(doc) else np.empty(0, np.int64)
        self.text, self.span, self.gram, self.buckets = text, span, gram, buckets
        # The order of grams is that of the bucket, then of the hash's high half.
        key = (g % U64(buckets)) << U64(32) | g >> U64(32)
        self.order = np.argsort(key)
        new = np.ones(len(key), bool)
        new[1:] = key[self.order][1:] != key[self.order][:-1]
        self.first = np.flatnonzero(new)
        self.grams = key[self.order[self.first]]
        self.of = np.empty(len(key), np.int64)  # gram of each string
        self.of[self.order] = np.cumsum(new) - 1
        self.cuts = np.searchsorted(self.grams, np.arange(buckets + 1, dtype=U64) << U64(32))

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each gram the number of strings (by hash), and whether several documents of the chunk have it."""
        if not len(self.grams):
            return np.empty(0, np.int64), np.empty(0, bool)
        both = np.sort(self.of.astype(U64) << U64(40) | self.hash >> U64(24))
        distinct = np.append(both[1:] != both[:-1], True)
        own = self.owner[self.order]
        return np.bincount((both[distinct] >> U64(40)).astype(np.int64)), np.minimum.reduceat(own, self.first) != np.maximum.reduceat(own, self.first)

    def choose(self, wanted: np.ndarray) -> None:
        """Tell the strings of the wanted grams apart: `some` has one of each distinct one, `least` its smallest doc_id.

        `asked` are all strings of the wanted grams, and `group` the distinct string of each. Strings of one hash are
        compared on their bytes with the first of them; one that differs stands for itself.
        """
        self.asked = np.flatnonzero(wanted[self.of])
        h = self.hash[self.asked]
        order = np.argsort(h, kind="stable")
        new = np.ones(len(h), bool)
        new[1:] = h[order][1:] != h[order][:-1]
        lead = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(h) else order
        first = np.empty(len(h), np.int64)
        first[order] = lead
        other = np.flatnonzero(first != np.arange(len(h)))
        a, b = self.asked[other], self.asked[first[other]]
        n = self.p1[a] + self.span - self.p0[a]
        same = n == self.p1[b] + self.span - self.p0[b]
        bad = [other[~same]]
        a, b, n, other = a[same], b[same], n[same], other[same]
        if len(n):
            cuts = np.searchsorted(np.cumsum(n), np.arange(0, int(n.sum()) + COMPARED_AT_ONCE, COMPARED_AT_ONCE)).tolist()
            for x, y in zip(cuts[:-1], [*cuts[1:-1], len(n)], strict=True):
                if x < y:
                    differ = self.text[ranges(self.p0[a[x:y]], n[x:y])] != self.text[ranges(self.p0[b[x:y]], n[x:y])]
                    bad.append(other[x:y][np.logical_or.reduceat(differ, np.cumsum(n[x:y]) - n[x:y])])
        alone = np.concatenate(bad)
        first[alone] = alone
        rep, self.group = np.unique(first, return_inverse=True)
        self.some = self.asked[rep]
        self.least = np.full(len(rep), LAST_ID, np.int64)
        np.minimum.at(self.least, self.group, self.owner[self.asked])


HOT_GRAM = 20_000  # different strings of one k-gram from which on they are split
COMPARED_AT_ONCE = 1 << 20  # bytes


def _gram_blobs(buckets: int, span: int, gram: int):
    def work(chunk: int, ids: np.ndarray, off: np.ndarray, text: np.ndarray) -> Iterator[pa.RecordBatch]:
        s = Strings(ids, off, text, buckets, span, gram)
        count, several = s.counts()
        info = (np.minimum(count, (1 << 15) - 1) | several.astype(np.int64) << 15).astype(np.uint16)
        low = (s.grams & U64(0xFFFFFFFF)).astype(np.uint32)
        rows = [(b, pack(low[x:y], info[x:y])) for b, (x, y) in enumerate(zip(s.cuts[:-1].tolist(), s.cuts[1:].tolist(), strict=True)) if x < y]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([chunk] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["bucket", "chunk", "blob"])

    return work


def _shared(hot: int):
    def work(table: pa.Table) -> pa.Table:
        """Per k-gram of each chunk: whether several documents have it, and whether too many strings do."""
        parts = [unpack(b) for b in table.column("blob").to_pylist()]
        _, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        info = np.concatenate([p[1] for p in parts]).astype(np.int64)
        n = np.bincount(back) + np.bincount(back, weights=info >> 15).astype(np.int64)
        total = np.bincount(back, weights=info & 0x7FFF)
        several, many = (n > 1)[back], (total > hot)[back]
        at = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])]).tolist()
        blobs = [pack(np.packbits(several[a:b]), np.flatnonzero(several[a:b] & many[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)]
        return _answers(table.column("chunk").to_pylist(), table.column("bucket")[0].as_py(), "shared", blobs)

    return work


ANSWER = "chunk long, bucket long, kind string, blob binary"


def _answers(chunks: list[int], bucket: int, kind: str, blobs: list[bytes]) -> pa.Table:
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "bucket": pa.array([bucket] * len(chunks), pa.int64()), "kind": pa.array([kind] * len(chunks), pa.string()), "blob": pa.array(blobs, pa.binary())})


def _rows(answers: pa.Table, wanted: str) -> Iterator[tuple[int, bytes]]:
    for bucket, kind, blob in zip(answers.column("bucket").to_pylist(), answers.column("kind").to_pylist(), answers.column("blob"), strict=True):
        if kind == wanted:
            yield bucket, blob.as_py()


def _chosen(ids: np.ndarray, off: np.ndarray, text: np.ndarray, answers: pa.Table, buckets: int, span: int, gram: int) -> tuple[Strings, np.ndarray]:
    """The chunk's strings with the shared ones told apart, and which grams are hot."""
    s = Strings(ids, off, text, buckets, span, gram)
    wanted, hot = np.zeros(len(s.grams), bool), np.zeros(len(s.grams), bool)
    for bucket, blob in _rows(answers, "shared"):
        a, b = s.cuts[bucket], s.cuts[bucket + 1]
        bits, many = unpack(blob)
        wanted[a:b] = np.unpackbits(bits, count=b - a)
        hot[a + many.astype(np.int64)] = True
    s.choose(wanted)
    return s, hot


def _sides(s: Strings, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes from the anchor on and bytes before it (nearest first) as zero-filled rows, and their lengths."""
    q, p0, p1 = s.q[some], s.p0[some], s.p1[some]
    right, left = p1 + s.span - q, q - p0
    n, across = len(some), 8 * (-(-s.span // 8))
    r = np.zeros((n, across), np.uint8)
    r.reshape(-1)[ranges(np.arange(n) * across, right)] = s.text[ranges(q, right)]
    wide = _wide(s.span, s.gram)
    lft = np.zeros((n, wide), np.uint8)
    rows = ranges(np.arange(n) * wide, left)
    back = np.repeat(q - 1, left) - (rows - np.repeat(np.arange(n) * wide, left))
    lft.reshape(-1)[rows] = s.text[back]
    return r, lft, right, left


def _wide(span: int, gram: int) -> int:
    return 8 * max(1, -(-(span - gram) // 8))


def _dealt(s: Strings, hot: np.ndarray, r: np.ndarray, lft: np.ndarray, right: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each distinct string: those of hot grams once by each side's bytes (buckets of their own)."""
    gram = s.of[s.some]
    plain = (s.grams[gram] >> U64(32)).astype(np.int64)
    much = hot[gram]
    if not much.any():
        return np.arange(len(plain)), plain
    half = (s.span - s.gram) // 2
    rows, dealt = [np.flatnonzero(~much)], [plain[~much]]
    for side, (part, fits) in enumerate(((r[:, s.gram : s.gram + half], right >= s.gram + half), (lft[:, : half + 1], left >= half + 1))):
        own = np.flatnonzero(much & fits)
        h = s.grams[gram[own]].copy()
        for k in range(part.shape[1]):
            h = mix(h ^ (part[own, k].astype(U64) + U64(1)))
        rows.append(own)
        dealt.append((h % U64(s.buckets)).astype(np.int64) + (side + 1) * s.buckets)
    return np.concatenate(rows), np.concatenate(dealt)


def _run_blobs(buckets: int, span: int, gram: int):
    def work(chunk: int, ids: np.ndarray, off: np.ndarray, text: np.ndarray, answers: pa.Table) -> list[pa.RecordBatch]:
        s, hot = _chosen(ids, off, text, answers, buckets, span, gram)
        r, lft, right, left = _sides(s, s.some)
        index, bucket = _dealt(s, hot, r, lft, right, left)
        words = r.view(">u8")[index]
        order = np.lexsort((right[index], *(words[:, k] for k in range(words.shape[1] - 1, -1, -1)), bucket))
        index, bucket = index[order], bucket[order]
        r, lft, right, left = r[index], lft[index], right[index], left[index]
        shared = _neighbours(r, right)
        begins = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
        rows = []
        for x, y in zip(begins, [*begins[1:], len(bucket)], strict=True):
            lcp = shared[x:y].copy()
            lcp[0] = 0
            n = right[x:y] - lcp
            tails = r[x:y].reshape(-1)[ranges(np.arange(y - x) * r.shape[1] + lcp, n)]
            before = lft[x:y].reshape(-1)[ranges(np.arange(y - x) * lft.shape[1], left[x:y])]
            rows.append((int(bucket[x]), pack(lcp, n, tails, left[x:y], before, s.least[index[x:y]], index[x:y])))
        return [pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([chunk] * len(rows), pa.int64()), pa.array([x[1] for x in rows], pa.binary())], ["bucket", "chunk", "blob"])]

    return work


def _neighbours(r: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row shares with the one before it."""
    out = np.zeros(len(r), np.int64)
    if len(r) > 1:
        differs = r[1:] != r[:-1]
        out[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), r.shape[1])
        out[1:] = np.minimum(out[1:], np.minimum(right[1:], right[:-1]))
    return out


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> tuple[list[int], list[int]]:
    """Merge front-coded sorted runs: (shared prefix lengths, rests). Returns (run of each output, its common prefix).

    A loser tree over the runs. Every candidate carries its common prefix with the last winner: of two candidates the one
    that shares more is smaller, and only equal lengths make bytes be compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    cur: list[bytes] = [r[1][0] if r[1] else b"" for r in runs] + [b""] * (k - len(runs))
    left = [len(r[1]) for r in runs] + [0] * (k - len(runs))
    # A run at its end shares -1 bytes: that makes it larger than every other.
    lcp = [0 if n else -1 for n in left]
    pos = [0] * k

    def beyond(a: int, b: int, same: int) -> int:
        """Of two candidates that share `same` bytes with the last winner: the larger one, which is given what it shares
        with the smaller one. Equal ones keep their order."""
        x, y = cur[a], cur[b]
        if x == y:
            lcp[b] = len(x)
            return b
        most = min(len(x), len(y))
        u, v = x[same:most], y[same:most]
        if u == v:
            larger = b if len(x) < len(y) else a
            lcp[larger] = most
            return larger
        z = int.from_bytes(u) ^ int.from_bytes(v)
        at = most - 1 - (z.bit_length() - 1) // 8
        larger = b if x[at] < y[at] else a
        lcp[larger] = at
        return larger

    tree = [-1] * k + list(range(k))
    loser = [-1] * k
    for node in range(k - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        g, h = lcp[a], lcp[b]
        worse = beyond(a, b, g) if g == h >= 0 else b if g >= h else a
        tree[node], loser[node] = a + b - worse, worse
    top = tree[1]
    order, common = [], []
    tails = [r[1] for r in runs]
    shared = [r[0] for r in runs]
    out, prefix = order.append, common.append
    while lcp[top] >= 0:
        out(top)
        prefix(lcp[top])
        at = pos[top] = pos[top] + 1
        if at < left[top]:
            h = lcp[top] = shared[top][at]
            cur[top] = cur[top][:h] + tails[top][at]
        else:
            h = lcp[top] = -1
        node = (top + k) // 2
        while node:
            other = loser[node]
            g = lcp[other]
            if g > h:
                loser[node], top, h = top, other, g
            elif g == h >= 0:
                # The winner of two keeps what it shares with the last output.
                if beyond(top, other, h) == top:
                    loser[node], top = top, other
            node //= 2
    return order, common


def _merge(span: int, gram: int, buckets: int):
    half = (span - gram) // 2

    def work(table: pa.Table) -> pa.Table:
        """Merge a bucket's runs and answer which windows an earlier document has, as bits by distance to the anchor."""
        chunks, bucket = table.column("chunk").to_pylist(), table.column("bucket")[0].as_py()
        # Strings of hot grams are dealt twice; each deal decides the windows that reach far enough on its side.
        distances = (range(span - gram + 1), range(half + 1), range(half + 1, span - gram + 1))[bucket // buckets]
        parts = [unpack(b) for b in table.column("blob").to_pylist()]
        runs = []
        for lcp, n, tails, *_ in parts:
            raw, ends = tails.tobytes(), np.cumsum(n, dtype=np.int64).tolist()
            runs.append((lcp.tolist(), [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]))
        order, common = merge_runs(runs)
        del runs
        order = np.array(order, np.int64)
        lcp = np.array(common, np.int64)
        # Output i of run r is the run's next row, so a stable sort by run finds the rows again.
        place = np.empty(len(order), np.int64)
        place[np.argsort(order, kind="stable")] = np.arange(len(order))
        join = lambda k: np.concatenate([p[k].astype(np.int64) for p in parts])
        right = (join(0) + join(1))[place]
        left_n, owner, index = join(3), join(5)[place], join(6)[place]
        wide = _wide(span, gram)
        lft = np.zeros((len(order), wide), np.uint8)
        lft.reshape(-1)[ranges(np.arange(len(order)) * wide, left_n)] = np.concatenate([p[4] for p in parts])
        lft, left_n = lft[place].view(">u8").astype(U64), left_n[place]
        marks = np.zeros(len(order), U64)
        for a in distances:
            apart = lcp < span - a
            apart[0] = True
            block = np.cumsum(apart) - 1
            fits = (left_n >= a) & (right >= span - a)
            sizes = np.bincount(block[fits], minlength=block[-1] + 1)
            rows = np.flatnonzero(fits & (sizes[block] > 1))
            if not len(rows):
                continue
            keys = [block[rows]]
            for w in range(-(-a // 8)):
                x = lft[rows, w]
                keys.append(x if a >= 8 * (w + 1) else x >> U64(64 - 8 * (a - 8 * w)))
            way = np.lexsort(keys[::-1])
            rows = rows[way]
            new = np.ones(len(rows), bool)
            new[1:] = False
            for key in keys:
                key = key[way]
                new[1:] |= key[1:] != key[:-1]
            least = np.minimum.reduceat(owner[rows], np.flatnonzero(new))
            later = rows[owner[rows] > least[np.cumsum(new) - 1]]
            marks[later] |= U64(1) << U64(a)
        found = np.flatnonzero(marks)
        run = order[found]
        way = np.argsort(run, kind="stable")
        found, run = found[way], run[way]
        who, at = np.unique(run, return_index=True)
        cuts = np.append(at, len(run)).tolist()
        blobs = [pack(index[found[x:y]], marks[found[x:y]]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        return _answers([chunks[w] for w in who.tolist()], bucket, "marked", blobs)

    return work


def covered(s: Strings, answers: pa.Table) -> np.ndarray:
    """Which of the chunk's bytes go."""
    marks = np.zeros(len(s.some), U64)
    for _, blob in _rows(answers, "marked"):
        index, bits = unpack(blob)
        marks[index.astype(np.int64)] |= bits
    gone = s.owner[s.asked] > s.least[s.group]
    edge = np.zeros(len(s.text) + 1, np.int32)
    np.add.at(edge, s.p0[s.asked[gone]], 1)
    np.add.at(edge, s.p1[s.asked[gone]] + s.span, -1)
    part = np.flatnonzero(~gone & (marks[s.group] != 0))
    bits, q = marks[s.group[part]], s.q[s.asked[part]]
    for a in range(s.span - s.gram + 1 if len(part) else 0):
        hit = q[(bits >> U64(a)) & U64(1) != 0] - a
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + s.span, -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(ids: np.ndarray, off: np.ndarray, text: np.ndarray, answers: pa.Table, buckets: int, span: int, gram: int) -> tuple[np.ndarray, list[bytes]]:
    """Which bytes go, and what each document keeps."""
    gone = covered(_chosen(ids, off, text, answers, buckets, span, gram)[0], answers)
    kept = text[~gone].tobytes()
    at = np.concatenate([[0], np.cumsum(~gone)])[off].tolist()
    return gone, [kept[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _results(buckets: int, span: int, gram: int):
    def work(chunk: int, ids: np.ndarray, off: np.ndarray, text: np.ndarray, answers: pa.Table) -> list[pa.RecordBatch]:
        gone, raw = _cut(ids, off, text, answers, buckets, span, gram)
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        begins[off[:-1][off[:-1] < len(text)]] = gone[off[:-1][off[:-1] < len(text)]]
        count = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[off])
        columns = [
            pa.array([None if i == LAST_ID else i for i in ids.tolist()], pa.int64()), pa.array(np.diff(off), pa.int64()), pa.array(count(gone), pa.int64()), pa.array(count(begins), pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
        ]
        return [pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])]

    return work


def _texts(buckets: int, span: int, gram: int):
    def work(chunk: int, ids: np.ndarray, off: np.ndarray, text: np.ndarray, answers: pa.Table) -> tuple[None, dict[str, pa.Array]]:
        _, raw = _cut(ids, off, text, answers, buckets, span, gram)
        texts = [x.decode("utf-8", "ignore") for x in raw]
        return None, {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}

    return work


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
BLOB = "bucket long, chunk long, blob binary"


def _decided(chunks: Chunks, span: int, gram: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """The answers of rounds 1 and 2, each a written table."""
    if not 0 < gram <= span or span - gram >= 64 or span > 255:
        raise ValueError("the k-gram must fit the span, with fewer than 64 bytes more, in a span of 255 at most")
    args = (chunks.buckets, span, gram)
    shared = materialise(chunks.gathered(chunks.each(_gram_blobs(*args), BLOB), _shared(hot), ANSWER), "suffix-shared")
    runs = chunks.answered(shared, _run_blobs(*args), BLOB)
    return shared, materialise(chunks.gathered(runs, _merge(span, gram, chunks.buckets), ANSWER), "suffix-marked")


def dedup(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot: int = HOT_GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256 of every document."""
    chunks = Chunks(docs)
    try:
        shared, marked = _decided(chunks, span, gram, hot)
        out = materialise(chunks.answered(shared.unionByName(marked), _results(chunks.buckets, span, gram), RESULT), "suffix-result")
        forget(shared, marked)
        return out
    finally:
        chunks.drop()


def dedup_texts(docs: DataFrame, span: int = SPAN, gram: int = GRAM, hot: int = HOT_GRAM) -> DataFrame:
    """`docs` with the repeated bytes cut out of text; characters that a cut has broken go, and n_chars (if there) follows.

    Rows are carried in the chunks, so they keep all their columns whatever these are called. A row whose text is null
    stays as it is.
    """
    chunks = Chunks(docs, carry=True)
    try:
        shared, marked = _decided(chunks, span, gram, hot)
        out = materialise(chunks.rewritten(shared.unionByName(marked), _texts(chunks.buckets, span, gram)), "suffix-texts")
        forget(shared, marked)
        return out
    finally:
        chunks.drop()
