"""Operators on whole corpora: joins, dedup, decontamination, archives, URLs, chat, the pipeline."""

import hashlib
import json
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import chat, decontaminate, ngram_join, suffix_dedup, url_filter, warc
from ledgerline.llm.components import components
from ledgerline.llm.queries import URL_RULES

from .cases import hard_documents, no_documents

LAST = (1 << 63) - 1


def shingle_set(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute_join(rows, k=4, percent=85):
    sets = [(LAST if i is None else i, shingle_set(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = {}
    for k, (_, x) in enumerate(sets):
        for e in x:
            inverted.setdefault(e, []).append(k)
    for k, (i, x) in enumerate(sets):
        for m, shared in Counter(m for e in x for m in inverted[e] if m > k).items():
            if 100 * shared >= percent * (len(x) + len(sets[m][1]) - shared):
                a, b = top(i), top(sets[m][0])
                parent[max(a, b)] = min(a, b)
    return sorted((i, len(x), top(i)) for i, x in sets)


@pytest.mark.parametrize("group", [256, 4])
def test_ngram_join_on_hard_documents(spark, group):
    rows, df = hard_documents(spark)
    got = ngram_join.join(df, group=group)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    big = lambda x: LAST if x is None else x
    assert sorted((big(r.doc_id), r.n_shingles, big(r.component_id)) for r in got.collect()) == brute_join(rows)


def test_ngram_join_chains_near_the_threshold(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(12)]
    rows = []
    for i in range(150):
        t = [rnd.choice(words) for _ in range(rnd.choice([0, 1, 3, 5, 20, 40]))]
        if rows and rnd.random() < 0.7:
            t = rnd.choice(rows)[1].split()
            for _ in range(rnd.randrange(3)):
                if t:
                    t[rnd.randrange(len(t))] = rnd.choice(words)
        rows.append((i, " ".join(t)))
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), group=8)
    assert sorted(tuple(r) for r in got.collect()) == brute_join(rows)
    assert ngram_join.join(no_documents(spark)).count() == 0


@pytest.mark.parametrize("group", [256, 4])
def test_ngram_join_with_null_and_repeated_ids(spark, group):
    rnd = random.Random(8)
    text = lambda: " ".join(rnd.choice("abcdefghijklmnopqrst") + str(rnd.randrange(30)) for _ in range(80))
    rows = []
    for i in range(12):
        t = text()
        rows += [(i, t), ([None, 100, 101][i % 3] if i < 9 else 200 + i, t + " more")]
    rows += [(100, None), (101, ""), (None, None), (300, text()), (301, None), (300, text())]
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), group=group)
    big = lambda x: LAST if x is None else x
    assert sorted((big(r.doc_id), r.n_shingles, big(r.component_id)) for r in got.collect()) == brute_join(rows)


@pytest.mark.parametrize("group", [256, 4])
def test_ngram_links_between_classes(spark, group):
    rows, df = hard_documents(spark)
    pairs, members = ngram_join.links(df, group=group)
    sets = {}
    for i, t in rows:
        if x := shingle_set(t):
            sets.setdefault(x, []).append(i)
    key = lambda ids: tuple(sorted(-1 if i is None else i for i in ids))
    classes = {}
    for r in members.collect():
        classes.setdefault(r["class"], []).append(r.doc_id)
    assert sorted(map(key, classes.values())) == sorted(map(key, sets.values()))
    want = {frozenset((key(a), key(b))): len(x & y) for x, a in sets.items() for y, b in sets.items() if x != y and 100 * len(x & y) >= 85 * len(x | y)}
    got = [(frozenset((key(classes[r.a]), key(classes[r.b]))), r.shared) for r in pairs.collect()]
    assert dict(got) == want and len(got) == len(want)


def test_sizes_of_links_are_one_step_apart():
    for percent in (50, 80, 85, 99, 100):
        for n in range(1, 3000):
            least = ngram_join.overlap_needed(n, percent)
            assert ngram_join.size_step(n, percent) - ngram_join.size_step(max(1, least), percent) <= 1


def test_divide_skip_counts_like_a_scan():
    import numpy as np

    rnd = random.Random(1)
    sets = [np.unique(np.array([rnd.randrange(60) for _ in range(rnd.randrange(1, 40))], np.uint64)) for _ in range(40)]
    index = ngram_join.InvertedIndex(sets)
    for q in range(40):
        for needed in (1, 3, max(1, len(sets[q]) // 2), len(sets[q])):
            want = {d: n for d in range(40) if d != q and (n := len(np.intersect1d(sets[q], sets[d]))) >= needed}
            assert index.search(q, needed) == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (50, 60), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 50, 50: 50, 60: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_dedup(rows, span):
    first = {}
    for i, t in rows:
        for p in range(len(t) - span + 1):
            w = t[p : p + span]
            first[w] = min(first.get(w, 1 << 70), i)
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - span + 1):
            if first[t[p : p + span]] < i:
                gone[p : p + span] = b"\1" * span
        kept = bytes(c for c, x in zip(t, gone, strict=True) if not x)
        out.append((i, len(t), sum(gone), sum(1 for k in range(len(t)) if gone[k] and not (k and gone[k - 1])), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def kept_bytes(rows, span):
    """doc_id, text and the bytes that stay of each row, by looking every window up."""
    first = {}
    every = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in every:
        for p in range(len(t) - span + 1):
            first[t[p : p + span]] = min(first.get(t[p : p + span], 1 << 70), i)
    for (i, text), (k, t) in zip(rows, every, strict=True):
        gone = bytearray(len(t))
        for p in range(len(t) - span + 1):
            if first[t[p : p + span]] < k:
                gone[p : p + span] = b"\1" * span
        yield i, text, bytes(c for c, x in zip(t, gone, strict=True) if not x)


@pytest.mark.parametrize(("span", "gram"), [(20, 7), (50, 16)])
def test_suffix_dedup_on_hard_documents(spark, span, gram):
    rows, df = hard_documents(spark)
    every = [(LAST if i is None else i, (t or "").encode()) for i, t in rows]
    for hot in (suffix_dedup.HOT_GRAM, 2):
        got = suffix_dedup.dedup(df, span, gram, hot)
        assert sorted((LAST if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == brute_dedup(every, span)


def test_suffix_dedup_on_repetitive_bytes(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(90):
        t = "".join(rnd.choice(["ab", "aa", "b", "é", "a" * 10]) for _ in range(rnd.randint(0, 40)))
        if rows and rnd.random() < 0.5:
            o = rnd.choice(rows)[1]
            a = rnd.randrange(len(o) + 1)
            t = t[:10] + o[a : a + rnd.randrange(60)] + t[10:]
        rows.append((rnd.choice([i, i, i // 2]), t))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for hot in (suffix_dedup.HOT_GRAM, 1):
        got = sorted(tuple(r) for r in suffix_dedup.dedup(df, 20, 7, hot).collect())
        assert got == brute_dedup([(i, t.encode()) for i, t in rows], 20)


def test_suffix_dedup_does_not_trust_hashes(spark, monkeypatch):
    import numpy as np

    # Every string of a chunk has the same hash: they are told apart on their bytes.
    anchored = suffix_dedup.anchored
    monkeypatch.setattr(suffix_dedup, "anchored", lambda *a: (*(x := anchored(*a))[:4], np.zeros_like(x[4]), x[5]))
    rnd = random.Random(9)
    part = [bytes(rnd.choice(b"abc") for _ in range(40)) for _ in range(6)]
    texts = [b"".join(rnd.choice(part) for _ in range(5)) for _ in range(30)]
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    s = suffix_dedup.Strings(np.arange(30), off, np.frombuffer(b"".join(texts), np.uint8), 4, 20, 7)
    s.choose(np.ones(len(s.grams), bool))
    raw = b"".join(texts)
    value = lambda k: raw[s.p0[k] : s.p1[k] + 20]
    assert all(value(k) == value(s.some[g]) for k, g in zip(s.asked, s.group, strict=True))


def test_suffix_dedup_texts(spark):
    rows, df = hard_documents(spark)
    got = suffix_dedup.dedup_texts(df.withColumn("n_chars", F.length("text")).withColumn("_id", F.lit(1)).withColumn("no_text", F.lit("z")))
    assert got.columns == [*df.columns, "n_chars", "_id", "no_text"] and got.count() == len(rows)
    assert got.where("n_chars <> length(text) or n_chars is null and text is not null").count() == 0
    whole = sorted((LAST if i is None else i, len((t or "").encode()), hashlib.sha256(k).hexdigest()) for i, t, k in kept_bytes(rows, 50))
    digests = {(i, n): h for i, n, _, _, h in brute_dedup([(LAST if i is None else i, (t or "").encode()) for i, t in rows], 50)}
    assert {(i, n): h for i, n, h in whole} == digests
    want = Counter((i, t if t is None else k.decode("utf-8", "ignore"), "x", 1.0, "c") for i, t, k in kept_bytes(rows, 50))
    assert Counter((r.doc_id, r.text, r.component_id, r.score, r.chunk) for r in got.collect()) == want
    assert suffix_dedup.dedup_texts(no_documents(spark)).count() == 0


def test_loser_tree_keeps_common_prefixes():
    rnd = random.Random(3)
    shared = lambda p, q: next((i for i, (a, b) in enumerate(zip(p, q, strict=False)) if a != b), min(len(p), len(q)))
    for _ in range(100):
        runs, every = [], []
        for _ in range(rnd.randint(1, 7)):
            x = sorted("".join(rnd.choice("ab") for _ in range(rnd.randint(0, 9))).encode() for _ in range(rnd.randint(0, 12)))
            lcp = [0, *[shared(p, q) for p, q in zip(x[:-1], x[1:], strict=True)]][: len(x)]
            runs.append((lcp, [s[k:] for s, k in zip(x, lcp, strict=True)]))
            every.append(x)
        order, common = suffix_dedup.merge_runs(runs)
        at, out = [0] * len(runs), []
        for r in order:
            out.append(every[r][at[r]])
            at[r] += 1
        assert out == sorted(sum(every, []))
        assert common[1:] == [shared(p, q) for p, q in zip(out[:-1], out[1:], strict=True)]


def test_decontamination(spark, monkeypatch):
    rnd = random.Random(6)
    vocabulary = [f"word{i}" for i in range(400)]
    item = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(k, item(rnd.choice([1, 2, 4, 5, 6, 12, 30, 70]))) for k in range(40)] + [(90, ""), (91, None), (92, "word1"), (None, item(9))]
    docs = [(i, item(rnd.choice([3, 200]))) for i in range(60)] + [(None, item(30)), (99, None)]
    for k, text in items[:20]:
        w = text.split()
        for x in range(max(0, len(w) // 9)):
            w[x] = "other"
        docs.append((200 + k, item(500) + ", " + " ".join(w).upper().replace(" ", "\n ") + "! " + item(3000)))
    benchmark = spark.createDataFrame([(k, t, 0) for k, t in items + items[:5]], "item_id long, text string, doc_id int")
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    words = lambda t: re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (t or "").lower())
    grams = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    want = set()
    for k, t in items:
        w = words(t)
        n = min(5, len(w))
        for i, text in docs:
            if n and 100 * len(grams(w, n) & grams(words(text), n)) >= 80 * len(grams(w, n)):
                want.add((i, k))
    clash = df.withColumn("_id", F.lit(1)).withColumn("found_items", F.lit(2)).withColumn("row_number", F.lit(3))
    for block in (32 << 20, 4000):
        monkeypatch.setattr(decontaminate, "INDEX_BYTES", block)
        assert Counter((r.doc_id, r.item_id) for r in decontaminate.hits(df, benchmark).collect()) == Counter(want)
        found = decontaminate.report(df, benchmark)
        assert found.count() == len(docs)
        assert {(r.doc_id, tuple(r.item_ids)) for r in found.where("contaminated").collect()} == {(i, tuple(sorted(k for d, k in want if d == i and k is not None))) for i, _ in want}
        kept = decontaminate.clean(clash, benchmark)
        assert kept.columns == clash.columns and kept.count() == len(docs) - len({i for i, _ in want})
    assert decontaminate.report(df, benchmark.limit(0)).where("contaminated").count() == 0
    assert decontaminate.report(no_documents(spark), benchmark).count() == 0


def test_warc(spark):
    long = "x" * 100
    rows = [(3, "http://a", long), (1, "http://b", long), (2, "u", "short"), (4, None, "short"), (5, "v\r\nInjected: yes", None), (1, "http://b", long), (None, "n", long), (6, "é", "é" * 50)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    store = warc.archive(pages)
    assert store.payloads.count() == 4
    got = sorted(((-1 if r.page_id is None else r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_back(store).collect())
    assert got == [(-1, 100, "revisit", 1), (1, 100, "response", None), (1, 100, "response", None), (2, 5, "response", None), (3, 100, "revisit", 1), (4, 5, "response", None), (5, 0, "response", None), (6, 100, "response", None)]
    ids, bodies = set(), []
    for (raw,) in warc.records(store).collect():
        head, _, block = bytes(raw).partition(b"\r\n\r\n")
        lines = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length"} <= set(lines) and b"Injected" not in lines
        assert re.fullmatch(rb"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", lines[b"WARC-Record-ID"])
        assert block[int(lines[b"Content-Length"]) :] == b"\r\n\r\n"
        ids.add(lines[b"WARC-Record-ID"])
        if lines[b"WARC-Type"] == b"response":
            http, _, body = block[:-4].partition(b"\r\n\r\n")
            assert http.startswith(b"HTTP/1.1 200") and int(http.rpartition(b": ")[2]) == len(body)
            assert lines[b"WARC-Payload-Digest"] == b"sha256:" + hashlib.sha256(body).hexdigest().encode()
            bodies.append(body.decode())
    assert len(ids) == len(rows) and sorted(bodies) == sorted([long, long, "short", "short", "", "é" * 50])
    rebuilt = warc.records(store)
    with pytest.raises(Exception, match="as long as it says"):
        warc.parsed(rebuilt.select(F.concat("record", F.lit(b"x")).alias("record"))).collect()
    bad = warc.Archive(spark, store.name, store.headers)
    spark.sql(f"CREATE OR REPLACE TEMP VIEW damaged AS SELECT digest, encode('x', 'UTF-8') AS payload FROM {store.name}")
    bad.name = "damaged"
    with pytest.raises(Exception, match="differs from its digest"):
        warc.records(bad).collect()
    store.drop()
    empty = warc.archive(pages.limit(0))
    assert warc.read_back(empty).count() == 0
    empty.drop()


def test_url_parts_and_rules(spark):
    cases = [
        (None, "", "", None), ("", "", "", None), ("foo/bar", "", "", None), ("http://A.Org", "a.org", "", None), ("http://A.Org/", "a.org", "/", "org/"), ("http://x.example.ORG/es/a?b#c", "x.example.org", "/es/a", "example.org/es/"),
        ("http://h?x://y/z", "h", "", None), ("http://u.com/fr/x", "u.com", "/fr/x", "com/fr/"), ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1"), ("http://notorg/", "notorg", "/", None),
        ("x://com/de/", "com", "/de/", "com/de/"), ("http://org/a", "org", "/a", "org/"), ("http://b.com/De/", "b.com", "/De/", None),
    ]
    pages = spark.createDataFrame([(k, c[0], "r") for k, c in enumerate(cases)], "page_id long, url string, rule string")
    got = {r.page_id: r for r in url_filter.judge(pages, URL_RULES).collect()}
    for k, (_, host, path, rule) in enumerate(cases):
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule)
        if rule:
            assert got[k].verdict == dict(URL_RULES)[rule]
    assert url_filter.judge(pages.limit(0), URL_RULES).count() == 0


def brute_judge(spark, urls):
    """(rule, verdict, score) of each url, from the definition: counts over the strings, threshold by trying every one."""
    def parts(u):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
        return (m[1].lower(), m[2]) if m else ("", "")

    def ruled(u):
        host, path = parts(u)
        fits = [r for r, _ in URL_RULES if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])]
        return max(fits, key=len) if fits else None

    body = [re.sub(r"(?s)^.*?://", "", u or "", count=1).encode() for u in urls]
    rules = [ruled(u) for u in urls]
    label = [None if r is None else dict(URL_RULES)[r] == "allow" for r in rules]
    hashed = spark.createDataFrame([(k, b.decode()) for k, b in enumerate(body)], "k long, body string").selectExpr("k", "pmod(xxhash64(body), 5) = 0 as back").collect()
    back = {r.k: r.back for r in hashed}
    longest = url_filter.longest_context(sum(len(b) + 1 for b, x in zip(body, label, strict=True) if x is not None))

    def model(which):
        runs, follow = Counter(), {}
        for b in which:
            s = ["start", *b, "end"]
            for i in range(1, len(s)):
                for n in range(min(i, longest) + 1):
                    context = tuple(s[i - n : i])
                    runs[context, s[i]] += 1
                    follow.setdefault(context, Counter())[s[i]] += 1

        def p(context, symbol):
            lower = 1 / 257 if not context else p(context[1:], symbol)
            f = follow.get(context, Counter())
            total = sum(f.values())
            return (f[symbol] + len(f) * lower) / (total + len(f)) if total >= (2 if len(context) > 2 else 1) else lower

        return p

    def score(b, models):
        s = ["start", *b, "end"]
        logs = [math.log(m) for i in range(1, len(s)) for m in [models[0](tuple(s[max(0, i - longest) : i]), s[i]) / models[1](tuple(s[max(0, i - longest) : i]), s[i])]]
        return sum(logs) / len(logs) if b else 0.0

    pick = lambda want, fit: [b for k, b in enumerate(body) if label[k] is want and not (fit and back[k])]
    fit, full = ([model(pick(True, f)), model(pick(False, f))] for f in (True, False))
    held = [(score(b, fit), label[k]) for k, b in enumerate(body) if label[k] is not None and back[k]]
    good, bad = sum(x for _, x in held), sum(not x for _, x in held)
    bins = sorted({math.floor(s * url_filter.BIN + 0.5) for s, _ in held})
    edges = [bins[0] - 0.5, *[(a + b) / 2 for a, b in zip(bins[:-1], bins[1:], strict=True)], bins[-1] + 0.5]
    balance = lambda e: sum(math.floor(s * url_filter.BIN + 0.5) > e for s, x in held if x) / good + sum(math.floor(s * url_filter.BIN + 0.5) < e for s, x in held if not x) / bad
    top = max(map(balance, edges))
    limit = min((e for e in edges if balance(e) >= top - 1e-12), key=abs) / url_filter.BIN
    scores = [score(b, full) for b in body]
    verdict = [("allow" if x else "block") if x is not None else "allow" if not b or s >= limit else "block" for b, x, s in zip(body, label, scores, strict=True)]
    return list(zip(rules, verdict, scores, strict=True)), limit


def test_url_judge_equals_brute_force(spark, monkeypatch):
    rnd = random.Random(1)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(rnd.randint(3, 8)))
    good = [f"http://{word('abcdé')}.org/{word('xy?=&')}" for _ in range(60)]
    bad = [f"http://{word('cvwxyz')}.com/de/{word('123')}" for _ in range(60)]
    free = ["http://abcdabcd.net/", "http://vwxyzvwx.net/", None, "", "http://", "ab.org", "http://漢字.net/#1", "http://net/" + "q" * 3000] + [f"http://{word('abcdvwxyz')}.net/{word('12?xy')}" for _ in range(20)]
    urls = [*good, *bad, *free, *good[:9]]
    want, limit = brute_judge(spark, urls)
    pages = spark.createDataFrame([(k, u, "r", "b") for k, u in enumerate(urls)], "page_id long, url string, rule string, body string").repartition(3)
    for at_once in (512 << 10, 300):
        monkeypatch.setattr(url_filter, "CHUNK_BYTES", at_once)
        got = {r.page_id: r for r in url_filter.judge(pages, URL_RULES).collect()}
        assert len(got) == len(urls) and abs(got[0].threshold - limit) < 1e-9
        for k, (rule, verdict, score) in enumerate(want):
            assert (got[k].rule, got[k].verdict) == (rule, verdict) and abs(got[k].score - score) < 1e-6, urls[k]
    assert [got[120 + k].verdict for k in range(5)] == ["allow", "block", "allow", "allow", "allow"]


def test_url_models_of_one_kind_allow(spark):
    rows = [(1, "http://a.org/"), (2, "http://b.org/x"), (3, "http://c.net/"), (None, None)]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).collect()
    assert {(r.verdict, r.score, r.threshold) for r in got} == {("allow", 0.0, 0.0)}


SCHEMAS = {"add": {"required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": "number"}, "unit": {"type": "string", "enum": ["m", "km"]}}, "additionalProperties": False}}


def test_chat_links_orders_and_validates(spark):
    say = lambda **kw: json.dumps(kw)
    rows = [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", say(tool_calls=[{"id": "c2", "name": "add", "arguments": {"a": 2, "b": 1.5}, "depends_on": ["c1"]}, {"id": "c1", "name": "add", "arguments": {"unit": "m", "a": 1}}])),
        (1, 2, "tool", say(tool_call_id="c2", content="r2")),
        (1, 3, "tool", say(tool_call_id="c1", content="r1")),
        (1, 4, "tool", say(tool_call_id="zz", content="lost")),
        (1, 5, "tool", say(tool_call_id="c1", content="again")),
        (2, 0, "assistant", say(tool_calls=[{"id": "c1", "name": "add", "arguments": {"a": "1", "c": 1}}, {"id": "c3", "name": "nope", "arguments": {}}, {"id": "c4", "name": "add", "arguments": [1]}])),
        (3, 0, "assistant", say(tool_calls=[{"id": "x", "name": "add", "arguments": {"a": 1}, "depends_on": ["y"]}, {"id": "y", "name": "add", "arguments": {"a": 1}, "depends_on": ["x"]}])),
        (None, 0, "user", None), (4, 0, None, "plain"), (4, 0, None, "plain"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, status string")
    out = chat.formatted(*chat.from_messages(df), SCHEMAS)
    got = sorted(out.collect(), key=lambda r: (r.conv_id is not None, r.conv_id, r.order_turn, r.order_depth, r.turn, r.kind, r.call_id or ""))
    one = [(r.kind, r.call_id, r.status, r.partner_turn) for r in got if r.conv_id == 1]
    assert one == [("message", None, "plain", None), ("call", "c1", "linked", 3), ("result", "c1", "linked", 1), ("call", "c2", "linked", 2), ("result", "c2", "linked", 1), ("result", "zz", "orphan", None), ("result", "c1", "duplicate", None)]
    assert next(r.json for r in got if r.call_id == "c1" and r.kind == "call" and r.conv_id == 1) == '{"arguments":{"a":1,"unit":"m"},"id":"c1","name":"add","type":"tool_call"}'
    assert {(r.call_id, r.status, "; ".join(r.errors)) for r in got if r.conv_id == 2} == {("c1", "invalid", "a: not integer; c: not allowed"), ("c3", "invalid", "unknown tool"), ("c4", "invalid", "arguments: not an object")}
    assert {(r.call_id, r.status) for r in got if r.conv_id == 3} == {("x", "blocked"), ("y", "blocked")}
    assert [r.json for r in got if r.conv_id == 4] == ['{"content":"plain","type":"message"}']
    assert chat.formatted(*chat.from_messages(df.limit(0)), SCHEMAS).count() == 0


def test_chat_from_turns_is_native_and_equals_sql(spark, small, capsys, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from ledgerline.llm.queries import OP6_SQL, op6_chat

    out = op6_chat(spark, small)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{small}/conversations.parquet')")
    found = con.execute(OP6_SQL)
    names = [c[0] for c in found.description]
    rows = sorted(repr(tuple(r)) for r in out.select(*names).collect())
    assert rows == sorted(repr(tuple(r)) for r in found.fetchall())
    assert {r.status for r in out.select("status").distinct().collect()} >= {"linked", "orphan", "duplicate", "blocked", "invalid", "unanswered", "plain"}
    assert out.agg(F.max("order_depth")).first()[0] > 0
    out.explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow", plan) and "ShuffledHashJoin" in plan


def brute_places(calls, results):
    """Place of each call by walking its dependencies; None for one that is blocked."""
    later = lambda a, b: (a[0], a[1] + 1) if a >= b else b
    memo = {}

    def place(c, path=()):
        if c not in calls or c in path:
            return None
        if c not in memo:
            turn, needs = calls[c]
            ends = []
            for n in needs:
                p = place(n, (*path, c))
                ends.append(None if p is None else later(p, (results[n], 0)) if n in results else p)
            got = None if None in ends else later(max(ends), (turn, 0)) if ends else (turn, 0)
            if path:
                return got
            memo[c] = got
        return memo[c]

    return {c: place(c) for c in calls}


@pytest.mark.parametrize("at_once", [256, 5])
def test_chat_order_equals_brute_force(spark, monkeypatch, at_once):
    monkeypatch.setattr(chat, "CALLS_AT_ONCE", at_once)
    rnd = random.Random(7)
    calls, results, want = [], [], {}
    for conv in range(60):
        n = rnd.randrange(1, 9)
        ids = [f"c{k}" for k in range(n)]
        own = {c: (rnd.randrange(12), sorted({rnd.choice([*ids, "gone"] if rnd.random() < 0.2 else ids[:k] or ids) for _ in range(rnd.randrange(3))})) for k, c in enumerate(ids)}
        answered = {c: rnd.randrange(14) for c in ids if rnd.random() < 0.7}
        calls += [(conv, t, c, "add", '{"a":1}', needs) for c, (t, needs) in own.items()]
        results += [(conv, t, c, "r") for c, t in answered.items()]
        want |= {(conv, c): (own[c][0] if p is None else p[0], 0 if p is None else p[1], p is None) for c, p in brute_places(own, answered).items()}
    calls = spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>")
    results = spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string")
    got = chat.link(calls, results, SCHEMAS).where("kind = 'call'").collect()
    assert {(r.conv_id, r.call_id): (r.order_turn, r.order_depth, r.status == "blocked") for r in got} == want


def test_chat_settles_a_long_chain_in_one_expression(spark):
    n = 200
    calls = spark.createDataFrame([(1, n - k, f"c{k}", "add", '{"a":1}', [f"c{k - 1}"] if k else []) for k in range(n)], "conv_id long, turn long, call_id string, name string, arguments string, depends_on array<string>")
    results = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    got = {r.call_id: (r.order_turn, r.order_depth) for r in chat.link(calls, results, SCHEMAS).collect()}
    assert got == {f"c{k}": (n, k) for k in range(n)}


def test_pipeline_links_by_five_words_and_four_fifths(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    words = [f"w{i}" for i in range(50)]
    near = [*words[:25], "other", *words[26:]]  # 43 of 51 shingles of four words, 41 of 51 of five
    far = [*words[:15], "else", *words[16:35], "more", *words[36:]]  # 36 of 56 of five
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.keep_one_of_each_group(spark, df, "").collect()} == {1, 3}
    assert {(r.doc_id, r.component_id) for r in ngram_join.join(df).collect()} == {(1, 1), (2, 2), (3, 3)}


def test_pipeline_tells_rows_of_null_and_repeated_ids_apart(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    text = lambda k: " ".join(f"{k}w{i}" for i in range(60))
    rows = [(1, text("a")), (None, text("a") + " x"), (None, text("b")), (None, text("c")), (None, text("c")), (5, text("d")), (5, text("e") + " x"), (4, text("e")), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_each_group(spark, df, "").collect()]
    assert Counter(got) == Counter([(1, text("a")), (None, text("b")), (None, text("c")), (5, text("d")), (4, text("e")), (None, None), (None, None)])


def brute_pipeline(spark, docs, rows, labels, benchmark):
    """What `run` returns for rows (doc_id, text), stage by stage and document by document."""
    import numpy as np
    import public_tokenizers as tok
    import pyarrow as pa
    import tiktoken

    from ledgerline.llm import bpe, quality
    from ledgerline.llm.text import buffers

    forest = quality.fit(docs, labels)
    rows = [r for r in rows if forest.score(np.concatenate([quality.statistics(*buffers(pa.array([r[1] or ""])))]))[0] >= 0.5]
    component = {k: c for k, _, c in brute_join([(k, t) for k, (_, t) in enumerate(rows)], 5, 80)}
    first = {}
    for k, (i, t) in enumerate(rows):
        if shingle_set(t, 5):
            first[component[k]] = min(first.get(component[k], (LAST + 1, 0)), (LAST if i is None else i, k))
    stay = {k for _, k in first.values()}
    rows = [r for k, r in enumerate(rows) if k in stay or not shingle_set(r[1], 5)]
    rows = [(i, t if t is None else kept.decode("utf-8", "ignore")) for i, t, kept in kept_bytes(rows, 50)]
    words = lambda t: re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    items = [(min(5, len(w)), grams(w, min(5, len(w)))) for w in map(words, benchmark) if w]
    rows = [(i, t) for i, t in rows if not any(100 * len(g & grams(words(t), n)) >= 80 * len(g) for n, g in items)]
    lib = tiktoken.Encoding("own", pat_str=tok.PATTERN, mergeable_ranks=bpe.load_ranks(tok.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    out = []
    for i, t in rows:
        ids = lib.encode_ordinary(t or "")
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return out


def test_pipeline_equals_brute_force(spark, small, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rnd = random.Random(11)
    have = [(r.doc_id, r.text) for r in docs.collect()]
    text = max((t for _, t in have if len(t) < 3000), key=len)
    far = lambda k: " ".join(f"{w}{k}" if rnd.random() < 0.5 else w for w in text.split())
    more = [(None, None), (None, have[5][1]), (None, far(1)), (9001, ""), (9002, None), (9003, far(2)), (9003, far(3)), (9004, have[7][1] + " more"), (9005, text + " " + far(4) + " " + "lang ähnlich " * 9000), (have[3][0], have[3][1])]
    extra = spark.createDataFrame([(i, t, "en", "x", len(t) if t else None) for i, t in more], docs.schema)
    whole = docs.unionByName(extra)
    for c in ("_id", "_row", "rest0", "no_text", "found_items", "chunk", "features"):
        whole = whole.withColumn(c, F.lit(c))
    whole.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    at = str(tmp_path)
    labels, benchmark = spark.read.parquet(f"{at}/labels.parquet"), spark.read.parquet(f"{at}/benchmark.parquet")
    want = brute_pipeline(spark, spark.read.parquet(f"{at}/documents.parquet"), have + more, labels, [r.text for r in benchmark.collect()])
    got = corpus_pipeline.run(spark, at)
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)
    assert 100 < len(want) < len(have)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, whole, at).columns == whole.columns, name


def test_pipeline_of_nothing(spark, small, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_keeps_clean_documents(spark, small):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, small)
        assert after.columns == docs.columns, name
        kept = after
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    groups = {r.doc_id: r.component_id for r in ngram_join.join(docs).collect()}
    held = {r.doc_id for r in decontaminate.hits(docs, spark.read.parquet(f"{small}/benchmark.parquet")).collect()}
    clean = {i for i, q in labels.items() if q == 1 and groups[i] == i and i not in held}
    assert len(clean - ids) <= 0.03 * len(clean)
