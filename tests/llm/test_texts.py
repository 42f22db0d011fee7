"""Operators on single texts: BPE, token counts, transport streams, quality."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import bpe, mpegts, quality, token_counts
from ledgerline.llm.text import buffers, shingles, slices

from .cases import hard_documents, no_documents

tok = pytest.importorskip("public_tokenizers")
PATH = tok.path("byte_bpe_multi_50k.tiktoken")


def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=tok.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def odd_texts(n=300, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("ab é\n\t 12'!漢字🙂ĳß'sllreve") for _ in range(rnd.randint(0, 80))) for _ in range(n)]


def test_bpe_equals_the_library():
    enc, lib = bpe.encoder(PATH, tok.PATTERN), library()
    texts = [*odd_texts(), "", "a" * 3000, " " * 500 + "x", "don't they're I'll 'tis  's", "\r\n\r\n x"]
    data, off = buffers(pa.array(texts))
    ids, at = bpe.Batch(enc).ids(data, off)
    for k, t in enumerate(texts):
        want = lib.encode_ordinary(t)
        assert ids[at[k] : at[k + 1]].tolist() == want, repr(t)
        assert enc.encode(t) == want
        assert enc.decode(want) == t.encode()


def test_bpe_append_and_edit_are_exact():
    enc, rnd = bpe.encoder(PATH, tok.PATTERN), random.Random(2)
    for _ in range(200):
        piece = bytes(rnd.choice(b"abcdein ") for _ in range(rnd.randint(1, 120)))
        last = enc.last_tokens(piece)
        assert enc.append(last, piece, b"arianism") == enc.last_tokens(piece + b"arianism")
        at = rnd.randrange(len(piece))
        new, table = enc.edit(last, piece, at, rnd.randrange(len(piece) - at + 1), bytes(rnd.choice(b"aein") for _ in range(rnd.randrange(5))))
        assert table == enc.last_tokens(new)
        assert enc.read_off(table) == enc.merged(new)


def test_bpe_query_on_hard_documents(spark):
    rows, df = hard_documents(spark)
    lib = library()
    want = sorted((-1 if i is None else i, len(x := lib.encode_ordinary(t or "")), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(df, PATH, tok.PATTERN).collect())
    assert got == want
    round_trip = bpe.decode(bpe.encode(df, PATH, tok.PATTERN), PATH, tok.PATTERN).collect()
    assert sorted(bytes(r.bytes) for r in round_trip) == sorted((t or "").encode() for _, t in rows)
    assert bpe.digests(no_documents(spark), PATH, tok.PATTERN).count() == 0


def test_token_counts_equal_a_unigram_library():
    from tokenizers import Tokenizer, models

    pieces = token_counts.load_pieces(tok.path("piece_bpe_32k.model"))
    lib = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces.items()], 0, False))
    words = sorted({token_counts.MARK + w for t in ["the quick brownish fox is overestimating", "Straße naïve éléphant", "aaaaaaaaaaaaaaa inini"] for w in t.split()})
    assert token_counts.Counter(pieces).counts(words) == [len(lib.encode(w).ids) for w in words]


def test_token_counts_do_not_depend_on_sharing():
    pieces = {"a": -1.0, "b": -2.0, "ab": -2.5, "ba": -1.5, "aba": -3.0, token_counts.MARK: -0.5}
    rnd = random.Random(0)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 9))) for _ in range(300)})
    shared = token_counts.Counter(pieces).counts(words)
    assert shared == [token_counts.Counter(pieces).counts([w])[0] for w in words]

    floor = min(pieces.values()) - token_counts.UNKNOWN

    def brute(word):
        best = [(0.0, 0)]
        for i in range(1, len(word) + 1):
            ways = [(best[j][0] + (pieces[word[j:i]] if word[j:i] in pieces else floor), best[j][1] + 1) for j in range(i) if word[j:i] in pieces or i - j == 1]
            best.append(max(ways, key=lambda w: (w[0], -w[1])))
        return best[-1][1]

    assert shared == [brute(w) for w in words]


def test_token_counts_on_hard_documents(spark):
    rows, df = hard_documents(spark)
    path = tok.path("piece_bpe_32k.model")
    split = lambda t: [w for w in re.split(r"[ \t\n\r\x0b\x0c]+", t or "") if w]
    first = token_counts.load_pieces(path)
    used, one = {}, token_counts.Counter(first)
    for w, many in Counter(token_counts.MARK + w for _, t in rows for w in split(t)).items():
        for p, n in one.usage([w], [1]).items():
            used[p] = used.get(p, 0) + n * many
    total = sum(n for p, n in used.items() if p in first) + len(first)
    scores = token_counts.fit(df, path)
    assert scores.keys() == first.keys() and all(abs(scores[p] - math.log((used.get(p, 0) + 1) / total)) < 1e-9 for p in first)
    assert abs(sum(map(math.exp, scores.values())) - 1) < 1e-6
    counter = token_counts.Counter(scores)
    known = {w: counter.counts([token_counts.MARK + w])[0] for w in {w for _, t in rows for w in split(t)}}
    want = sorted((-1 if i is None else i, len(split(t)), sum(known[w] for w in split(t))) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_tokens) for r in token_counts.token_counts(df, path).collect()) == want
    assert token_counts.token_counts(no_documents(spark), path).count() == 0


def test_token_counts_do_not_trust_hashes(monkeypatch):
    monkeypatch.setattr(token_counts, "span_hashes", lambda data, s, e: np.zeros(len(s), np.uint64))
    pieces = {token_counts.MARK: -1.0, "a": -2.0, "b": -2.0, "ab": -2.5}
    data, off = buffers(pa.array(["ab a ab", "b abab", ""]))
    assert [x.tolist() for x in token_counts.Worker(pieces).totals(data, off)] == [[3, 2, 0], [6, 5, 0]]


@pytest.mark.parametrize("n", [0, 1, 161, 162, 163, 346, 2921, 2922, 2923, 5844, 100_000])
def test_transport_stream_round_trip(n):
    payload = random.Random(n).randbytes(n)
    stream = mpegts.mux(payload)
    found = mpegts.demux(stream)
    assert found["payload"] == payload and len(stream) % 188 == 0
    assert (np.diff(found["pts"]) == mpegts.UNIT_TICKS).all() and found["sizes"].sum() == n
    assert found["random_access"].tolist() == [k % mpegts.GOP == 0 for k in range(len(found["pts"]))]


def test_transport_stream_damage_is_found():
    stream = bytearray(mpegts.mux(b"x" * 5000))
    for at, what in ((0, "sync"), (188 * 3 + 3, "continuity"), (20, "damaged")):
        bad = bytearray(stream)
        bad[at] ^= 1
        with pytest.raises(mpegts.StreamError, match=what):
            mpegts.demux(bytes(bad))
    with pytest.raises(mpegts.StreamError):
        mpegts.demux(bytes(stream[:-188]))


def ts_packet(pid, payload, counter, start=False, flags=None, control=None):
    """One packet; an adaptation field (its flag byte, if any) fills up what the payload leaves."""
    room = 184 - len(payload)
    body = b""
    if room or flags is not None:
        body = bytes([room - 1]) + (bytes([flags or 0]) + b"\xff" * (room - 2) if room > 1 else b"")
    kind = control or (0x30 if body else 0x10)
    return bytes([0x47, start << 6 | pid >> 8, pid & 255, kind | counter & 15]) + body + payload


def ts_section(table, key, body):
    head = bytes([table, 0xB0 | (len(body) + 9) >> 8, (len(body) + 9) & 255, key >> 8, key & 255, 0xC1, 0, 0]) + body
    return head + mpegts.crc32_mpeg(head).to_bytes(4, "big")


def ts_pes(data, length=None, stamp=b"\x21\x00\x01\x00\x03", sid=0xE0):
    n = len(data) + 3 + len(stamp) if length is None else length
    return b"\0\0\1" + bytes([sid, n >> 8, n & 255, 0x80, 0x80 if stamp else 0, len(stamp)]) + stamp + data


def test_foreign_transport_stream():
    # A map whose descriptors fill several packets, a network entry, two programs, and two streams of the second.
    descriptors = bytes([0x05, 200]) + b"d" * 200 + bytes([0x0A, 4]) + b"eng\0"
    pmt = ts_section(2, 7, b"\xe1\x01" + bytes([0xF0 | len(descriptors) >> 8, len(descriptors) & 255]) + descriptors + b"\x03\xe1\x02\xf0\x03abc" + b"\x1b\xe1\x03\xf0\x00")
    other = ts_section(2, 9, b"\xe0\x50\xf0\x00\x0f\xe0\x50\xf0\x00")
    pat = ts_section(0, 1, b"\0\0\xe0\x10" + b"\0\x09\xe0\x31" + b"\0\x07\xe0\x30")
    first, rest = (b"\0" + pmt)[:184], (b"\0" + pmt)[184:]
    null = ts_packet(0x1FFF, b"n" * 184, 3)
    a, b = b"x" * 184, b"y" * 100
    one = ts_pes(b"1" * 100, stamp=bytes([0x21, 0, 1, 0, 0x21]))  # stamp 16
    packets = [
        null, ts_packet(0, b"\0" + pat, 0, True), ts_packet(0x31, b"\0" + other, 0, True), ts_packet(0x30, first, 4, True), null, ts_packet(0x30, rest, 5),
        ts_packet(0x102, b"audio", 0), ts_packet(0x103, one, 14, True, flags=0x40), ts_packet(0x103, b"", 14, flags=0, control=0x20),
        ts_packet(0x103, ts_pes(b"2" * 170, length=0), 15, True), ts_packet(0x103, a, 0), ts_packet(0x103, a, 0), ts_packet(0x103, b, 1),
        ts_packet(0x103, ts_pes(b"3" * 9, stamp=b""), 9, True, flags=0x80), ts_packet(0x103, ts_pes(b"", 0, b"", sid=0xBE)[:6] + b"pad", 10, True),
    ]
    found = mpegts.demux(b"".join(packets), program=7, stream_type=0x1B)
    assert found["streams"] == [(3, 0x102), (0x1B, 0x103)]
    assert found["payload"] == b"1" * 100 + b"2" * 170 + a + b + b"3" * 9 + b"pad"
    assert found["sizes"].tolist() == [100, 454, 9, 3] and found["pts"].tolist() == [16, 1, -1, -1] and found["random_access"].tolist() == [True, False, False, False]
    for bad, why in (
        (packets[:9] + [ts_packet(0x103, ts_pes(b"2" * 170, length=0), 1, True)], "jumps"),
        (packets[:12] + [ts_packet(0x103, a, 0)], "jumps"),  # sent three times
        (packets[:7] + [ts_packet(0x103, ts_pes(b"1" * 100, length=200), 14, True)], "incomplete"),
        (packets[:4], "no packet of table 2"),
        (packets[:7] + [ts_packet(0x103, b"no start code", 1, True)], "no start code"),
    ):
        with pytest.raises(mpegts.StreamError, match=why):
            mpegts.demux(b"".join(bad), program=7, stream_type=0x1B)
    for wanted in ({"program": 3}, {"program": 7, "stream_type": 2}):
        with pytest.raises(mpegts.StreamError, match="no such"):
            mpegts.demux(b"".join(packets), **wanted)


def test_tables_repeat_before_random_access():
    stream = mpegts.mux(b"z" * (mpegts.UNIT_BYTES * 20))
    packets = np.frombuffer(stream, np.uint8).reshape(-1, 188)
    tables = packets[mpegts._pids(packets) == 0]
    assert len(tables) == 3 and (tables[:, 3] & 15).tolist() == [0, 1, 2]
    assert mpegts.demux(stream)["payload"] == b"z" * (mpegts.UNIT_BYTES * 20)


def test_transport_stream_query(spark):
    rows, df = hard_documents(spark)
    got = mpegts.features(mpegts.media_table(df)).collect()
    want = sorted((hashlib.sha256(p := mpegts.padded((t or "").encode())).hexdigest(), len((t or "").encode()), len(p), zlib.crc32(p[-64:])) for _, t in rows)
    assert sorted((r.payload_sha256, r.n_bytes, r.payload_bytes, r.tail_crc32) for r in got) == want
    assert all(r.payload_bytes % 64 == 0 and r.payload_bytes > 0 for r in got)
    assert mpegts.features(mpegts.media_table(no_documents(spark))).count() == 0


def test_shingles_against_tuples():
    texts = ["A b c d e", "a B c", "", "a a a a a a a", " x\ty\nz w ", "é É ß ſ"]
    data, off = buffers(pa.array(texts))
    h, d = shingles(data, off, 4)
    low = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    for k, t in enumerate(texts):
        w = low(t)
        n = 0 if not w else 1 if len(w) < 4 else len({tuple(w[i : i + 4]) for i in range(len(w) - 3)})
        assert (d == k).sum() == n
    assert [x for x in slices(np.array([0, 5, 5, 30, 31]), 10)] == [(0, 2), (2, 3), (3, 4)]


def test_quality_learns_on_held_out_rows(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "labels"))
    got = quality.classify(docs, labels)
    assert got.count() == docs.count()
    held = got.join(labels, "doc_id").where("held_out").select("quality", "predicted").collect()
    assert sum(r.quality == r.predicted for r in held) >= 0.85 * len(held)
    assert {zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in got.where("held_out").collect()} == {True}


def test_quality_edges(spark):
    rows, df = hard_documents(spark)
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(40)] + [(None, 1, None), (41, None, None)], "doc_id long, quality int, text string")
    got = quality.classify(df, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.classify(df, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(no_documents(spark), labels).count() == 0
    assert quality.keep_good(df, labels).columns == df.columns
    forest = quality.train(np.random.default_rng(0).random((500, len(quality.FEATURES))).astype(np.float32), np.arange(500) % 2 * 1.0, trees=3)
    assert forest.leaf.shape == (3, 2**quality.DEPTH)


def test_forest_traversal_equals_walking_down():
    rng = np.random.default_rng(1)
    x = rng.random((800, len(quality.FEATURES))).astype(np.float32)
    forest = quality.train(x, (x[:, 3] + x[:, 5] > 1).astype(float), trees=12, depth=4)

    def walk(row):
        total = forest.base
        for f, t, leaf in zip(forest.feature, forest.threshold, forest.leaf, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + (row[f[node]] > t[node])
            total += leaf[node - len(f)]
        return 1 / (1 + np.exp(-total))

    scores = forest.score(x)
    assert np.allclose(scores, [walk(r) for r in x])
    assert ((scores >= 0.5) == (x[:, 3] + x[:, 5] > 1)).mean() > 0.9


def test_statistics_do_not_depend_on_neighbours(spark):
    rows, df = hard_documents(spark)
    texts = [t or "" for _, t in rows]
    data, off = buffers(pa.array(texts))
    together = quality.statistics(data, off)
    alone = np.concatenate([quality.statistics(*buffers(pa.array([t]))) for t in texts])
    assert np.allclose(together, alone, atol=1e-5)
    assert df.where(F.col("text").isNull()).count() == 2
