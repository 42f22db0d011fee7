"""Token counts by trie-shared dynamic programming over a unigram model.

The best segmentation of a pre-token is the one of the greatest sum of piece scores. Its forward scores depend on the
prefix alone, so pre-tokens are walked in sorted order, which is the depth-first order of their trie: each takes over the
scores of the prefix that it shares with the one before and only works on the rest. The number of pieces at the end of a
pre-token (its terminal count) is kept and looked up for all its occurrences.

Scores. The pieces come from a SentencePiece model file given by path; control, unknown, byte and unused pieces are left
out, and so are those that the file marks as never to be used (a score of NEVER or less). The file is a merge model, whose
scores are minus the rank of a merge and no logarithms of anything. `fit` makes unigram scores of them on the corpus: it
starts from Zipf's law over the ranks, segments every distinct pre-token of all documents by it, weighs the pieces used by
the pre-token's number of occurrences, and takes the logarithm of each piece's share (one added to each count). That is one
round of hard expectation-maximisation; its counts grow with the corpus, and the driver gets a number a piece.

Ties in the score take the fewest pieces. A character that no piece covers counts as unknown: one token each, with the
penalty UNKNOWN below the worst piece. White space is the pre-token border and stands as the piece mark at the front of each
word, as the library's default normaliser has it. Pre-tokens are found by 64-bit hashes and compared on their bytes. Null
and empty texts have 0 tokens; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import forget, materialise
from .text import BLOCK_BYTES, NOT_SPACE, buffers, ranges, slices, span_hashes, words

MARK = "▁"
UNKNOWN = 10.0
NEVER = -1e8
WORD_CACHE = 1_500_000  # distinct pre-tokens that a Python worker knows at most (about 60 MB); emptied when full
AT_ONCE = 1 << 20  # bytes of text segmented together
COUNTED_AT_ONCE = 4 << 20  # bytes of text whose pre-tokens are counted together


def load_pieces(path: str) -> dict[str, float]:
    """Normal pieces and their first scores: Zipf's law over the order that the file's scores give."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i)) and m.get_score(i) > NEVER]
    ranked = sorted(plain, key=lambda i: (-m.get_score(i), i))
    return {m.id_to_piece(i): -math.log(k + 2) for k, i in enumerate(ranked)}


class Counter:
    """Terminal counts of pre-tokens, by forward scores that sorted neighbours share."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN
        # Lengths of the pieces that end in three characters, longest first, so that only those are looked up.
        ends: dict[str, set[int]] = {}
        for p in pieces:
            if len(p) > 2:
                ends.setdefault(p[-3:], set()).add(len(p))
        self.ends = {k: sorted(v, reverse=True) for k, v in ends.items()}

    def extend(self, word: str, score: list[float], count: list[int], back: list[int]) -> None:
        """Forward scores, counts and beginnings of the last piece, of the prefixes of `word` beyond those that are there."""
        find, ends, unknown = self.pieces.get, self.ends.get, self.unknown
        for i in range(len(score), len(word) + 1):
            best, fewest, begin = score[i - 1] + unknown, count[i - 1] + 1, i - 1
            piece = find(word[i - 1])
            if piece is not None:
                best = score[i - 1] + piece
            if i > 1:
                for n in (*ends(word[i - 3 : i], ()), 2) if i > 2 else (2,):
                    j = i - n
                    if j < 0:
                        continue
                    piece = find(word[j:i])
                    if piece is not None:
                        s = score[j] + piece
                        if s > best or s == best and count[j] + 1 < fewest:
                            best, fewest, begin = s, count[j] + 1, j
            score.append(best)
            count.append(fewest)
            back.append(begin)

    def walk(self, words: list[str]) -> Iterator[tuple[str, list[int], list[int]]]:
        """Each word, in sorted order, with the counts and beginnings of its prefixes."""
        score, count, back, before = [0.0], [0], [0], ""
        for word in words:
            n, most = 0, min(len(before), len(word))
            while n < most and before[n] == word[n]:
                n += 1
            del score[n + 1 :], count[n + 1 :], back[n + 1 :]
            self.extend(word, score, count, back)
            yield word, count, back
            before = word

    def counts(self, words: list[str]) -> list[int]:
        """Terminal counts of words in sorted order."""
        return [count[-1] for _, count, _ in self.walk(words)]

    def usage(self, words: list[str], weights: list[int]) -> dict[str, int]:
        """How often each piece is used in the best segmentations of words (sorted), by their weights."""
        out: dict[str, int] = {}
        for (word, _, back), weight in zip(self.walk(words), weights, strict=True):
            i = len(word)
            while i:
                piece = word[back[i] : i]
                out[piece] = out.get(piece, 0) + weight
                i = back[i]
        return out


def _cut(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> list[str]:
    """The spans as strings, cut from one."""
    n = e - s
    joined = np.full(int(n.sum()) + len(n), 10, np.uint8)
    at = np.cumsum(n + 1) - n - 1
    joined[ranges(at, n)] = data[ranges(s, n)]
    return joined.tobytes().decode("utf-8").split("\n")[:-1]


def _differ(a: np.ndarray, s: np.ndarray, e: np.ndarray, b: np.ndarray, t: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Whether the spans s..e of a differ from t..u of b."""
    out = e - s != u - t
    same = np.flatnonzero(~out & (e > s))
    n = (e - s)[same]
    if len(n):
        out[same] = np.logical_or.reduceat(a[ranges(s[same], n)] != b[ranges(t[same], n)], np.cumsum(n) - n)
    return out


class Worker:
    """Counts whole blocks of documents; distinct pre-tokens stay known from block to block (up to WORD_CACHE)."""

    def __init__(self, pieces: dict[str, float]):
        self.counter = Counter(pieces)
        self.forget()

    def forget(self) -> None:
        self.known, self.count, self.at = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.bytes, self.ends = np.empty(0, np.uint8), np.zeros(1, np.int64)  # of all known ones, as `at` numbers them

    def learn(self, data: np.ndarray, hashes: np.ndarray, s: np.ndarray, e: np.ndarray) -> None:
        """Count new pre-tokens, given in the order of their hashes."""
        text = [MARK + w for w in _cut(data, s, e)]
        order = sorted(range(len(text)), key=text.__getitem__)
        found = np.empty(len(text), np.int64)
        found[order] = self.counter.counts([text[k] for k in order])
        at = len(self.ends) - 1 + np.arange(len(hashes))
        self.bytes = np.concatenate([self.bytes, data[ranges(s, e - s)]])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(e - s)])
        place = np.searchsorted(self.known, hashes)
        self.known, self.count, self.at = np.insert(self.known, place, hashes), np.insert(self.count, place, found), np.insert(self.at, place, at)

    def totals(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pre-tokens and tokens of each document."""
        n_docs = len(off) - 1
        s, e, doc = words(data, off, NOT_SPACE)
        if not len(s):
            return np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
        unique, first, back = np.unique(span_hashes(data, s, e), return_index=True, return_inverse=True)
        for _ in range(2):
            at = np.minimum(np.searchsorted(self.known, unique), max(0, len(self.known) - 1))
            new = np.flatnonzero(self.known[at] != unique) if len(self.known) else np.arange(len(unique))
            if not len(new):
                break
            if len(self.known) and len(self.known) + len(new) > WORD_CACHE:
                self.forget()
                new = np.arange(len(unique))
            self.learn(data, unique[new], s[first[new]], e[first[new]])
        count = self.count[at][back]
        place = self.at[at][back]
        wrong = np.flatnonzero(_differ(data, s, e, self.bytes, self.ends[place], self.ends[place + 1]))
        if len(wrong):  # pre-tokens that share a hash with another one
            count[wrong] = [self.counter.counts([MARK + w])[0] for w in _cut(data, s[wrong], e[wrong])]
        return np.bincount(doc, minlength=n_docs), np.bincount(doc, weights=count, minlength=n_docs).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n: every pre-token of all documents and how often it stands there. Blocks count first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(0))
            for i, j in slices(off, COUNTED_AT_ONCE):
                parts = []
                for a, b in slices(off[i : j + 1], BLOCK_BYTES):
                    low = off[i + a]
                    block = data[low : off[i + b]]
                    s, e, _ = words(block, off[i + a : i + b + 1] - low, NOT_SPACE)
                    parts.append((s + low, e + low, span_hashes(block, s, e)))
                s, e, h = (np.concatenate(x) for x in zip(*parts, strict=True))
                _, first, back, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                lead = first[back]
                wrong = np.flatnonzero(_differ(data, s, e, data, s[lead], e[lead]))
                np.subtract.at(n, back[wrong], 1)
                text = _cut(data, np.concatenate([s[first], s[wrong]]), np.concatenate([e[first], e[wrong]]))
                yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()), pa.array(np.concatenate([n, np.ones(len(wrong), np.int64)]))], ["word", "n"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, path: str) -> dict[str, float]:
    """Unigram scores of the file's pieces, from all pre-tokens of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(load_pieces(path))
        for batch in batches:
            found = counter.usage([MARK + w for w in batch.column(0).to_pylist()], batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["piece", "n"])

    counted = materialise(word_counts(docs).sortWithinPartitions("word"), "token-words")
    used = counted.mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    pieces = load_pieces(path)
    vocabulary = docs.sparkSession.createDataFrame([(p,) for p in pieces], "piece string")
    # Characters that no piece covers are left out, so that there is a row a piece at most.
    counts = {r.piece: r.n for r in used.join(vocabulary, "piece", "left_semi").collect()}
    forget(counted)
    total = math.log(sum(counts.values()) + len(pieces)) if pieces else 0.0
    return {p: math.log(counts.get(p, 0) + 1) - total for p in pieces}


#: What a Python worker has learnt of the scores that it used last.
_workers: dict[str, Worker] = {}


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_words (pre-tokens) and n_tokens of every whole text, by scores that `docs` themselves give."""
    scores = fit(docs, path)
    name = hashlib.sha256(repr(sorted(scores.items())).encode()).hexdigest()
    sent = docs.sparkSession.sparkContext.broadcast(scores)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _workers:
            _workers.clear()
            _workers[name] = Worker(sent.value)
        worker = _workers[name]
        for batch in batches:
            data, off = buffers(batch.column(1))
            parts = [worker.totals(data[off[i] : off[j]], off[i : j + 1] - off[i]) for i, j in slices(off, AT_ONCE)]
            n, m = (np.concatenate([p[k] for p in parts]) if parts else np.empty(0, np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(m, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return _texts(docs).mapInArrow(run, "doc_id long, n_words long, n_tokens long")
