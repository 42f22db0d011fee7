"""Vectorised byte kernels over Arrow string buffers: words, shingle hashes, document slices.

All of them work on whole texts, in blocks of whole documents, so memory is bounded by the block size or by the longest
document, whichever is larger. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 512 << 10  # of text handled at once
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SHINGLE = [U64(pow(0xD1342543DE82EF95, j + 1, 1 << 64)) for j in range(64)]
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the rolling base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 64)
        for k, base in enumerate((_BASE, _INVERSE)):
            x = np.full(size, base, U64)
            x[0] = 1
            _powers[k] = np.cumprod(x, dtype=U64)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every input bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values of a string or binary column, end to end, and the offsets of each value."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents with at most `limit` bytes together; a longer document is alone."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions begin[i] .. begin[i] + length[i] - 1, one range after the other."""
    stop = np.cumsum(length)
    return np.arange(stop[-1] if len(stop) else 0) + np.repeat(begin - stop + length, length)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    out = data.copy()
    out[(out >= 65) & (out <= 90)] += 32
    return out


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a : b + 1] = True
    return t


#: Bytes of words: all but ASCII white space, or ASCII letters and digits with all bytes above ASCII.
NOT_SPACE = ~_table((0x20, 0x20), (0x09, 0x0D))
ALNUM = _table((48, 57), (65, 90), (97, 122), (128, 255))


def words(data: np.ndarray, off: np.ndarray, member: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each maximal run of member bytes; runs never cross documents."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    word = member[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    full = off[:-1] < off[1:]
    before[off[:-1][full]] = False
    after[off[1:][full] - 1] = False
    s, e = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return s, e, np.searchsorted(off, s, side="right") - 1


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, by prefix sums of a polynomial."""
    power, inverse = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * power[:-1], out=sums[1:])
    return mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(U64))


def shingles(data: np.ndarray, off: np.ndarray, size: int, member: np.ndarray = NOT_SPACE, whole_short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document and their document numbers.

    `data` is lower-cased here (A-Z only). A document of fewer than `size` words has its whole word sequence as its one
    shingle if `whole_short`, else none; a document without words has none.
    """
    low = lower_ascii(data)
    s, e, doc = words(low, off, member)
    if not len(s):
        return np.empty(0, U64), np.empty(0, np.int64)
    w = span_hashes(low, s, e)
    count = np.bincount(doc, minlength=len(off) - 1)
    first = np.cumsum(count) - count
    parts, docs = [], []
    if len(w) >= size:
        m = len(w) - size + 1
        h = w[:m] * _SHINGLE[0]
        for j in range(1, size):
            h += w[j : j + m] * _SHINGLE[j]
        whole = doc[:m] == doc[size - 1 :]
        parts.append(mix(h[whole] + U64(size)))
        docs.append(doc[:m][whole])
    if whole_short and len(short := np.flatnonzero((count > 0) & (count < size))):
        h = np.zeros(len(short), U64)
        for j in range(size - 1):
            has = count[short] > j
            h[has] += w[first[short[has]] + j] * _SHINGLE[j]
        parts.append(mix(h + count[short].astype(U64)))
        docs.append(short)
    if not parts:
        return np.empty(0, U64), np.empty(0, np.int64)
    h, d = (parts[0], docs[0]) if len(parts) == 1 else (np.concatenate(parts), np.concatenate(docs))
    if len(parts) > 1:
        order = np.argsort(d, kind="stable")
        h, d = h[order], d[order]
    cuts = np.concatenate([[0], np.flatnonzero(d[1:] != d[:-1]) + 1, [len(d)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[keep], d[keep]
