"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a pre-token exactly one token can end its encoding. `last_tokens` stores it for each prefix, so
the encoding of any prefix is read off backwards, appends extend the table without touching what is there, and an edit
re-encodes from its own place on only (`Encoder.append`, `Encoder.edit`).

Correctness: an encoding is the BPE encoding if and only if each neighbouring pair of tokens is, so the token t ends
prefix i when t's bytes end it, t encodes itself, and the pair (last token of the shorter prefix, t) encodes as itself.
Pairs are settled once, from the tokens' own merges, and remembered. Whole pre-tokens that are ranked are single tokens, as in tiktoken.
Null text counts as empty.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import buffers, ranges, slices, span_hashes

WORD_CACHE = 600_000  # distinct pre-tokens kept by a worker; emptied when full
AT_ONCE = 512 << 10  # bytes of text encoded together
PAIR_CACHE = 100_000
NEVER = (1 << 31) - 1  # above every rank


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {v: k for k, v in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._pairs: dict[tuple[int, int], bool] = {}
        self._spines: dict[int, array] = {}

    def merged(self, piece: bytes, below: int = 1 << 60) -> list[int]:
        """The plain definition: merge the neighbours of lowest rank, leftmost first, until none is ranked under `below`."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if best >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _spine(self, token: int, right: bool) -> array:
        """The tokens that stand at one edge while `token` is merged together, each followed by the rank that uses it up.

        Byte by byte up to the token itself, which nothing uses up. Empty if the merges don't end in this one token.
        """
        key = token if right else ~token
        found = self._spines.get(key)
        if found is None:
            found, x, used = [], token, NEVER
            while True:
                found += (used, x)
                if len(self.tokens[x]) == 1:
                    break
                parts = self.merged(self.tokens[x], self.ranks[self.tokens[x]])
                if len(parts) != 2:
                    found = []
                    break
                used, x = x, parts[right]
            found = self._spines[key] = array("i", found[::-1])
        return found

    def settle(self, a: int, b: int) -> bool:
        """Whether the two tokens stay two: no token at a's right edge merges with one at b's left edge while both stand.

        Merges come in the order of their ranks; of equal ones the left one is first.
        """
        xs, ys, i, k, ok = self._spine(a, True), self._spine(b, False), 0, 0, True
        while ok:
            x, x_used, y, y_used = xs[i], xs[i + 1], ys[k], ys[k + 1]
            rank = self.ranks.get(self.tokens[x] + self.tokens[y])
            ok = rank is None or rank >= x_used or rank > y_used
            if x_used <= y_used:
                if i + 2 == len(xs):
                    break
                i += 2
            else:
                k += 2
        return ok

    def _pair(self, a: int, b: int) -> bool:
        """`settle`, remembered."""
        ok = self._pairs.get((a, b))
        if ok is None:
            if len(self._pairs) >= PAIR_CACHE:
                self._pairs.clear()
            ok = self._pairs[a, b] = self.settle(a, b)
        return ok

    def extend(self, piece: bytes, last: list[int]) -> list[int]:
        """Fill `last` (its entry i ends the encoding of the first i + 1 bytes) up to the end of `piece`."""
        find, longest, pairs, pair = self.ranks.get, self.longest, self._pairs, self._pair
        for i in range(len(last) + 1, len(piece) + 1):
            for j in range(i - longest if i > longest else 0, i):
                token = find(piece[j:i])
                if token is not None and self._spine(token, True):
                    if not j:
                        break
                    ok = pairs.get((last[j - 1], token))
                    if ok or ok is None and pair(last[j - 1], token):
                        break
            else:
                raise ValueError(f"no token ends byte {i} of a pre-token: the ranks lack single bytes")
            last.append(token)
        return last

    def last_tokens(self, piece: bytes) -> list[int]:
        return self.extend(piece, [])

    def read_off(self, last: list[int], end: int | None = None) -> list[int]:
        """The encoding of the first `end` bytes."""
        out, i = [], len(last) if end is None else end
        while i:
            out.append(token := last[i - 1])
            i -= len(self.tokens[token])
        return out[::-1]

    def append(self, last: list[int], piece: bytes, more: bytes) -> list[int]:
        """The table of `piece + more`, given that of `piece`: exact, and only the new bytes are worked on."""
        return self.extend(piece + more, list(last))

    def edit(self, last: list[int], piece: bytes, at: int, removed: int, added: bytes) -> tuple[bytes, list[int]]:
        """Replace `removed` bytes at `at`: entries before the edit stay; later ones are found again.

        Behind the edit, once the entries equal the old ones over a longest token's length, all further ones do too.
        """
        new = piece[:at] + added + piece[at + removed :]
        table, shift = last[:at], len(added) - removed
        edge, same = at + len(added), 0
        while len(table) < len(new):
            i = len(table)
            if i >= edge + self.longest and same >= self.longest:
                table.extend(last[i - shift :])
                break
            self.extend(new[: i + 1], table)
            same = same + 1 if i >= edge and table[i] == last[i - shift] else 0
        return new, table

    def encode_piece(self, piece: bytes) -> list[int]:
        token = self.ranks.get(piece)
        return [token] if token is not None else self.read_off(self.last_tokens(piece))

    def encode(self, text: str) -> list[int]:
        return [t for m in self.pattern.findall(text) for t in self.encode_piece(m.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Splitter:
    """The split of byte-level BPE's usual pattern, for whole buffers of documents at once.

    Classes of characters come from the pattern's own library. Words, numbers and other signs each take one space before
    them; white space keeps its last character back for what follows; the seven short forms after an apostrophe stand alone.
    `fits` says whether a pattern is that one; other patterns are split by the library, document by document.
    """

    #: The pattern's short forms and its text.
    SHORT = ("s", "t", "re", "ve", "m", "ll", "d")
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    _classes: np.ndarray | None = None

    @classmethod
    def fits(cls, pattern: str) -> bool:
        return pattern == cls.PATTERN

    @classmethod
    def classes(cls) -> np.ndarray:
        """0 other, 1 letter, 2 number, 3 white space, for every code point."""
        if cls._classes is None:
            table = np.zeros(0x110000, np.uint8)
            every = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)]).astype("<u4").tobytes().decode("utf-32-le")
            for k, kind in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\s+")):
                for m in regex.finditer(kind, every):
                    a, b = ord(every[m.start()]), ord(every[m.end() - 1])
                    table[a : b + 1] = k
            table[0xD800:0xE000] = 0
            cls._classes = table
        return cls._classes

    @classmethod
    def starts(cls, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Byte positions where pre-tokens begin; each document begins one."""
        if not len(data):
            return np.empty(0, np.int64)
        chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((data & 0xC0) != 0x80)  # byte of each character
        kind = cls.classes()[chars]
        n = len(chars)
        new_doc = np.zeros(n, bool)
        new_doc[np.searchsorted(at, off[:-1][off[:-1] < off[1:]])] = True
        change = np.ones(n, bool)
        change[1:] = kind[1:] != kind[:-1]
        change |= new_doc
        begin = change.copy()
        space = kind == 3
        # The last white-space character before something else in the same document: a pre-token begins there, and a
        # plain space takes what follows with it.
        last = np.zeros(n, bool)
        last[:-1] = space[:-1] & ~space[1:] & ~new_doc[1:]
        begin |= last
        taken = np.zeros(n, bool)
        taken[1:] = last[:-1] & (chars[:-1] == 0x20)
        begin &= ~taken
        # Short forms: an apostrophe that begins a pre-token, alone in its run, before one of the letter groups.
        quote = np.flatnonzero((chars == 0x27) & begin)
        quote = quote[quote + 1 < n]
        quote = quote[(kind[quote + 1] == 1) & ~new_doc[quote + 1]]
        for q in quote.tolist():
            rest = chars[q + 1 : q + 3]
            same_doc = len(rest) > 1 and not new_doc[q + 2]
            word = "".join(map(chr, rest[: 1 + same_doc].tolist()))
            form = next((f for f in cls.SHORT if word.startswith(f)), None)
            if form:
                begin[q + 1] = False
                after = q + 1 + len(form)
                if after < n:
                    begin[after] = begin[after] or kind[after] == 1
        return at[begin]


class Batch:
    """The same encoding for many pre-tokens at once: the prefix tables of all of them are filled together, end by end.

    Distinct pre-tokens are kept with their ids from batch to batch (up to WORD_CACHE). They are told apart by 64-bit
    hashes; decoded bytes that differ from the text would show a clash, and then the text is encoded alone.
    """

    def __init__(self, enc: Encoder):
        self.enc = enc
        children: dict[int, int] = {}
        token_of = [-1]
        for token, rank in enc.ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                nxt = children.get(key)
                if nxt is None:
                    nxt = children[key] = len(token_of)
                    token_of.append(-1)
                node = nxt
            token_of[node] = rank
        self.token_of = np.array(token_of, np.int32)
        keys = np.fromiter(children.keys(), np.int64, len(children))
        vals = np.fromiter(children.values(), np.int32, len(children))
        # Two-byte rows would be too wide: children are found in an open table with linear probing.
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys, self.vals = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        self.probes = 0
        while len(left):
            free = self.keys[slot[left]] == -1
            order = left[free]
            first = order[np.unique(slot[order], return_index=True)[1]]
            self.keys[slot[first]], self.vals[slot[first]] = keys[first], vals[first]
            left = np.setdiff1d(left, first, assume_unique=True)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            self.probes += 1
        size = max(enc.tokens) + 1
        self.length = np.zeros(size, np.int64)
        for rank, token in enc.tokens.items():
            self.length[rank] = len(token)
        self.bytes, self.bytes_at = self._pool([enc.tokens.get(i, b"") for i in range(size)])
        self.text, self.text_at = self._pool([b"%d," % i for i in range(size)])
        self.reach = np.full(size, -1, np.int8)
        self.pair_bits = 21
        self.pair_keys, self.pair_ok = np.full(1 << self.pair_bits, -1, np.int64), np.zeros(1 << self.pair_bits, bool)
        self.forget()

    def forget(self) -> None:
        self.known = np.empty(0, np.uint64)  # sorted hashes
        self.where = np.empty(0, np.int64)  # of each, its place in the pool
        self.pool, self.pool_at = np.empty(0, np.int32), np.zeros(1, np.int64)

    @staticmethod
    def _pool(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _child(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = node.astype(np.int64) << 8 | byte
        slot = self._slot(key)
        out = np.where(self.keys[slot] == key, self.vals[slot], 0)
        miss = np.flatnonzero((out == 0) & (self.keys[slot] != -1))
        for _ in range(1, self.probes):
            if not len(miss):
                break
            slot[miss] = (slot[miss] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[miss]]
            hit = there == key[miss]
            out[miss[hit]] = self.vals[slot[miss[hit]]]
            miss = miss[~hit & (there != -1)]
        return out

    def _pairs(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        key = before.astype(np.int64) << 32 | token
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.pair_bits)).astype(np.int64)
        ok = self.pair_ok[slot]
        miss = np.flatnonzero(self.pair_keys[slot] != key)
        if len(miss):
            unique, first, back = np.unique(key[miss], return_index=True, return_inverse=True)
            pair, reachable = self.enc.settle, self._reachable
            t = token[miss[first]]
            found = np.fromiter((pair(a, b) for a, b in zip(before[miss[first]].tolist(), t.tolist(), strict=True)), bool, len(unique)) & reachable(t)
            at = slot[miss[first]]
            self.pair_keys[at], self.pair_ok[at] = unique, found
            ok[miss] = found[back]
        return ok

    def _reachable(self, token: np.ndarray) -> np.ndarray:
        for t in np.unique(token[self.reach[token] < 0]).tolist():
            self.reach[t] = bool(self.enc._spine(t, True))
        return self.reach[token] > 0

    def tables(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """For each byte of the concatenated pre-tokens, the token that ends its prefix."""
        n = len(data)
        start = np.repeat(off[:-1], np.diff(off))
        stop = np.repeat(off[1:], np.diff(off))
        last = np.full(n, -1, np.int32)
        begins, ends, tokens = [], [], []
        at, node, step = np.arange(n), np.zeros(n, np.int32), 0
        while len(at):
            node = self._child(node, data[at + step])
            live = node > 0
            at, node = at[live], node[live]
            token = self.token_of[node]
            full = token >= 0
            begins.append(at[full])
            ends.append(at[full] + step)
            tokens.append(token[full])
            step += 1
            more = at + step < stop[at]
            at, node = at[more], node[more]
        begin, end, token = np.concatenate(begins), np.concatenate(ends), np.concatenate(tokens)
        depth = end - start[end]
        order = np.argsort(depth, kind="stable")
        begin, end, token, depth = begin[order], end[order], token[order], depth[order]
        whole = (begin == start[end]) & (end + 1 == stop[end])
        cuts = np.searchsorted(depth, np.arange(depth[-1] + 2 if len(depth) else 1)).tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            x, y, t = begin[a:b], end[a:b], token[a:b]
            first = x == start[x]
            ok = np.zeros(b - a, bool)
            ok[first] = self._reachable(t[first]) | whole[a:b][first]
            ok[~first] = self._pairs(last[x[~first] - 1], t[~first])
            last[y[ok]] = t[ok]
        last[end[whole]] = token[whole]
        if (last < 0).any():
            raise ValueError("no token ends a prefix of a pre-token: the ranks lack single bytes")
        return last

    def learn(self, data: np.ndarray, off: np.ndarray, hashes: np.ndarray) -> None:
        """Encode distinct pre-tokens, given end to end, and keep their ids."""
        last = self.tables(data, off)
        ends = np.zeros(len(data), bool)
        low = np.repeat(off[:-1], np.diff(off))
        at = off[1:] - 1
        while len(at):
            ends[at] = True
            back = at - self.length[last[at]]
            at = back[back >= low[at]]
        ids = last[ends]
        counts = np.add.reduceat(ends, off[:-1], dtype=np.int64)
        place = len(self.pool_at) - 1 + np.arange(len(hashes))
        self.pool = np.concatenate([self.pool, ids])
        self.pool_at = np.concatenate([self.pool_at, self.pool_at[-1] + np.cumsum(counts)])
        known, where = np.concatenate([self.known, hashes]), np.concatenate([self.where, place])
        order = np.argsort(known, kind="stable")
        self.known, self.where = known[order], where[order]

    def places(self, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Where in the pool the ids of each pre-token are; new ones are encoded."""
        h = span_hashes(data, s, e)
        unique, first, back = np.unique(h, return_index=True, return_inverse=True)
        for _ in range(2):
            at = np.minimum(np.searchsorted(self.known, unique), max(0, len(self.known) - 1))
            new = np.flatnonzero(self.known[at] != unique) if len(self.known) else np.arange(len(unique))
            if not len(new):
                break
            if len(self.known) and len(self.known) + len(new) > WORD_CACHE:
                self.forget()
                new = np.arange(len(unique))
            x, y = s[first[new]], e[first[new]]
            self.learn(data[ranges(x, y - x)], np.concatenate([[0], np.cumsum(y - x)]), unique[new])
        return self.where[at][back]

    def ids(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all documents end to end, and where each document's begin."""
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(off), np.int64)
        s = Splitter.starts(data, off)
        e = np.append(s[1:], len(data))
        place = self.places(data, s, e)
        count = self.pool_at[place + 1] - self.pool_at[place]
        ids = self.pool[ranges(self.pool_at[place], count)]
        total = np.concatenate([[0], np.cumsum(count)])
        return ids, total[np.searchsorted(s, off)]

    def spelled(self, ids: np.ndarray, pool: np.ndarray, pool_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pooled bytes of each id end to end, and where each id's begin."""
        n = pool_at[ids + 1] - pool_at[ids]
        return pool[ranges(pool_at[ids], n)], np.concatenate([[0], np.cumsum(n)])

    def digests(self, data: np.ndarray, off: np.ndarray) -> list[tuple[int, str, str]]:
        """Of each document: number of ids, SHA-256 of the ids joined by commas, SHA-256 of the bytes they decode to."""
        ids, at = self.ids(data, off)
        text, text_at = self.spelled(ids, self.text, self.text_at)
        decoded, decoded_at = self.spelled(ids, self.bytes, self.bytes_at)
        clash = len(decoded) != len(data) or not np.array_equal(decoded, data)
        out = []
        for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            if clash:
                own = self.enc.encode(data[off[k] : off[k + 1]].tobytes().decode("utf-8"))
                out.append((len(own), hashlib.sha256(",".join(map(str, own)).encode()).hexdigest(), hashlib.sha256(self.enc.decode(own)).hexdigest()))
                continue
            x = text[text_at[a] : max(text_at[a], text_at[b] - 1)]
            out.append((b - a, hashlib.sha256(x).hexdigest(), hashlib.sha256(decoded[decoded_at[a] : decoded_at[b]]).hexdigest()))
        return out


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(load_ranks(path), pattern)
    return _encoders[path, pattern]


def _batch(path: str, pattern: str) -> Batch | None:
    """The worker's batch encoder; None for a pattern that only its library splits."""
    if not Splitter.fits(pattern):
        return None
    if (path, pattern) not in _batches:
        _batches[path, pattern] = Batch(encoder(path, pattern))
    return _batches[path, pattern]


_batches: dict[tuple[str, str], Batch] = {}


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text: encoded and decoded where it lies, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, fast = encoder(path, pattern), _batch(path, pattern)
        for batch in batches:
            data, off = buffers(batch.column(1))
            rows = []
            for i, j in slices(off, AT_ONCE):
                part, own = data[off[i] : off[j]], off[i : j + 1] - off[i]
                if fast:
                    rows += fast.digests(part, own)
                    continue
                for k in range(i, j):
                    ids = enc.encode(data[off[k] : off[k + 1]].tobytes().decode("utf-8"))
                    rows.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(enc.decode(ids)).hexdigest()))
            n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and token_ids of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, fast = encoder(path, pattern), _batch(path, pattern)
        for batch in batches:
            data, off = buffers(batch.column(1))
            for i, j in slices(off, AT_ONCE):
                part, own = data[off[i] : off[j]], off[i : j + 1] - off[i]
                if fast:
                    ids, at = fast.ids(part, own)
                    column = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
                else:
                    column = pa.array([enc.encode(part[a:b].tobytes().decode("utf-8")) for a, b in zip(own[:-1], own[1:], strict=True)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], column], ["doc_id", "token_ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, token_ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the decoded bytes; an id that the ranks don't have fails the query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            out = pa.array([enc.decode(x or []) for x in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), out], ["doc_id", "bytes"])

    return encoded.select("doc_id", "token_ids").mapInArrow(run, "doc_id long, bytes binary")
