"""Readers, HTML, snapshots and whole plans."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import build, extraction, nightly, search
from ledgerline.sources import html, readers, snapshots
from ledgerline.sources.schemas import DOCUMENTS_LOG, RECORD, RECORD_HEADER


def write(path, text):
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return f"file://{path}"


def csv(tmp_path, rows, name="r.csv"):
    quote = lambda x: '"' + x.replace('"', '""') + '"'
    return write(tmp_path / name, "\n".join([",".join(RECORD_HEADER), *[",".join(map(quote, r)) for r in rows]]) + "\n")


ROW = ["A-1", "O4", "1", "Roads", 'ACME "X", INC', "$4,920.00", "1/2/2024", "12/31/2099", "Active", "https://h/S?A=1&D=2&DN=A-1&N=3&DT=O4&V=5", ""]


def test_csv_quotes_and_order(spark, tmp_path):
    path = csv(tmp_path, [ROW, [*ROW[:4], "TWO\nLINES", *ROW[5:]], [*ROW[:9], "", ""]])
    got = readers.records(spark, {"state": path}).orderBy("seq").collect()
    assert [r.vendor for r in got] == ['ACME "X", INC', "TWO\nLINES", 'ACME "X", INC']
    assert readers.keyed_records(spark, {"state": path}).count() == 2


def test_torn_csv_rows_and_open_quotes(spark, tmp_path):
    path = csv(tmp_path, [ROW, [*ROW[:4], "SECOND", *ROW[5:]]])
    assert readers.whole_records(spark, {"s": path}).count() == 2
    text = (tmp_path / "r.csv").read_text()
    assert [r.vendor for r in readers.whole_records(spark, {"s": write(tmp_path / "t.csv", text + "A-2,O4,1,Ro")}).orderBy("seq").collect()] == ['ACME "X", INC', "SECOND"]
    with pytest.raises(ValueError, match="open at the end"):
        readers.whole_records(spark, {"s": write(tmp_path / "u.csv", text + 'A-2,"O4')})


def test_since():
    assert str(nightly.since("3", dt.date(2026, 1, 5))) == "2026-01-02" and str(nightly.since("2025-02-03", dt.date(2026, 1, 5))) == "2025-02-03"


def test_jsonl_last_line_wins_and_torn_tail(spark, tmp_path):
    lines = ['{"k":"a","n":1}', '{"k":"b","n":2}', '{"k":"a","n":3,"doc":"x y"}']
    whole = write(tmp_path / "a.jsonl", "\n".join(lines) + "\n")
    torn = write(tmp_path / "b.jsonl", "\n".join(lines).encode() + b'\n{"k":"b","n":9,"doc":"\xc3')
    unended = write(tmp_path / "c.jsonl", "\n".join(lines))
    broken = write(tmp_path / "d.jsonl", lines[0] + "\n{oops\n" + lines[1] + "\n")
    fold = lambda p, **kw: sorted((r.k, r.n) for r in readers.folded(spark, p, DOCUMENTS_LOG, "k", **kw).collect())
    assert fold(whole) == fold(torn) == fold(unended) == [("a", 3), ("b", 2)]
    assert fold(unended, strict_tail=True) == [("a", 1), ("b", 2)]
    assert readers.folded(spark, whole, DOCUMENTS_LOG, "k").where("k='a'").first().doc == "x y"
    with pytest.raises(Exception, match="doesn't parse"):
        fold(broken)


def test_lines_keep_their_order_over_splits(spark, tmp_path):
    path = write(tmp_path / "n.txt", "\n".join(map(str, range(20000))) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = [int(r.value) for r in readers.lines(spark, path).orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(range(20000))


def test_source_texts_keep_an_earlier_text(spark):
    kind = "tok string, doc string, seq int, engines map<string,struct<text:string>>"
    df = spark.createDataFrame([("t", "d", 1, {"v": ("old",)}), ("t", "d", 2, {"v": ("new",)}), ("t", "d", 3, {"v": ("",)}), (None, "d", 4, {"v": ("x",)})], kind)
    assert [tuple(r) for r in readers.source_texts(df, "v").collect()] == [("t", "d", "new")]


def test_reference_maps_state_and_tags(spark, tmp_path):
    path = write(tmp_path / "m.json", '{"_about":"x","O4":"Purchase Order"}')
    assert [tuple(r) for r in readers.reference_map(spark, path).collect()] == [("O4", "Purchase Order")]
    lists = write(tmp_path / "g.json", '{"_c":["x"],"Acme":["ACME","ACME INC"]}')
    assert sorted(tuple(r) for r in readers.reference_lists(spark, lists).collect()) == [("Acme", "ACME"), ("Acme", "ACME INC")]
    tags = spark.createDataFrame([("data-1",), ("data-2",), ("other",)], "tag string")
    assert [r.tag for r in readers.newest_tag(tags, "data-").collect()] == ["data-2"]
    assert [r.tag for r in readers.newest_tag(tags, "data-1").collect()] == ["data-1"]
    bad = write(tmp_path / "s.json", "{no")
    assert readers.state(spark, bad, "a int").count() == 0
    assert os.path.exists(tmp_path / "s.json.corrupt")
    assert readers.state(spark, f"file://{tmp_path}/none.json", "a int").count() == 0


def test_html(spark):
    cells = "".join(f"<td>{x}</td>" for x in ["A-1", "O4", "1", "Roads &amp; Co", "ACME", "$1", "1/2/2024", "2/3/2024"])
    page = f'<table id="entitygrid"><tr><th>h</th></tr><tr>{cells}<td><a href="/d?A=1&amp;B=2">x</a></td></tr><tfoot><tr><td><a href="?page=17&amp;s=1">17</a> <a href="?page=2">99</a></td></tr></tfoot></table>'
    got = html.grid(spark.createDataFrame([(1, page)], "p int, html string")).collect()
    assert [(r.doc_number, r.entity_name, r.detail_url, r.last_page) for r in got] == [("A-1", "Roads & Co", "/d?A=1&B=2", 17)]
    files = '<tr><td><a href="V/ViewDocument?D=t1">One</a></td><td>1 KB</td></tr><tr><td><a href="V/ViewDocument?D=t1">Again</a></td><td>1 KB</td></tr><tr><td><a href="V/ViewDocument?D=t2">Two</a></td><td>2 KB</td></tr>'
    docs = html.document_list(spark.createDataFrame([(1, files), (2, "<p>"), (3, None)], "p int, html string")).orderBy("p").collect()
    assert [tuple(d) for d in docs[0].documents] == [("One", "1 KB", "t1"), ("Two", "2 KB", "t2")]
    assert docs[1].documents == [] and docs[2].documents is None
    opts = html.options(spark.createDataFrame([(1, '<option value="">All</option><option value="7">A &amp; B</option>')], "p int, html string"))
    assert [(r.name, r.value) for r in opts.collect()] == [("A & B", "7")]


def test_snapshots_swap_verify_and_prune(spark, tmp_path):
    store = snapshots.Store(spark, f"file://{tmp_path}/store")
    df = spark.range(10).select(F.col("id").alias("row_id"))
    with pytest.raises(FileNotFoundError):
        store.read("t")
    for k in (1, 2):
        build_name = store.new_build()
        store.write(build_name, "t", df.where(f"row_id < {5 * k}"))
        store.verify(build_name, "t", df.where(f"row_id < {5 * k}"))
        store.publish(build_name)
        assert store.read("t").count() == 5 * k
    with pytest.raises(ValueError, match="differ"):
        store.verify(build_name, "t", df.where("row_id < 9"))
    assert len(store.prune()) == 1 and store.builds() == [build_name]
    assert [r.rows for r in snapshots.checksum(df).collect()] == [10]


def test_build_publish_and_search(spark, tmp_path):
    other = ["B-2", *ROW[1:4], "Bolt & Co", "$10", "3/4/2020", "", "Active", "https://h/S?DN=B-2", ""]
    raw = readers.records(spark, {"state": csv(tmp_path, [ROW, ROW, [*ROW[:8], "Expired", *ROW[9:]], other])})
    rows = build.checked(build.published_rows(build.normalised(raw, spark.createDataFrame([("O4", "Purchase Order")], "key string, value string"))), ["Roads"])
    assert rows.count() == 2
    described = rows.select("k", F.lit("Snow removal services").alias("description")).limit(1)
    store = snapshots.Store(spark, f"file://{tmp_path}/pub")
    build.publish(rows, store, described)
    have = store.read("records")
    q = search.Query(vendor="acme", least="$1,000", words="snow rem", types=["Purchase Order"])
    index = store.read("index")
    wanted = {r.row_id for r in index.collect()}
    found = {r.row_id for r in search.search(have, search.Query(words="snow rem"), "2024-01-10", index).collect()}
    assert found == wanted and len(found) == 1
    assert [r.vendor for r in search.search(have, search.Query(), "2024-01-10").collect()] == ['ACME "X", INC', "Bolt & Co"]
    assert [r.vendor for r in search.search(have, search.Query(when="began30"), "2024-01-10").collect()] == ['ACME "X", INC']
    assert search.Query.parsed(q.permalink()) == q
    assert [r.vendor for r in build.as_csv(have, "2024-01-10").orderBy("vendor").collect()][0].startswith("ACME")
    with pytest.raises(ValueError, match="unknown entity"):
        build.checked(rows, ["Nobody"])


def night_row(url, entity="Roads", status="Active", amount="$1.00", seq=0):
    return ("A", "O4", "1", entity, "V", amount, "1/2/2024", "", status, url, "", "state", seq)


NIGHT = ", ".join(f"{n} string" for n in RECORD.names) + ", dataset string, seq int"


def test_night(spark):
    known = [night_row(f"u{i}", seq=i) for i in range(6)] + [night_row("old", status="Expired", seq=90), night_row("lost", status="Expired", seq=91)]
    records = spark.createDataFrame(known, NIGHT)
    seen = spark.createDataFrame([night_row(f"u{i}", amount="$2.00" if i == 1 else "$1.00", seq=100 + i) for i in range(5)] + [night_row("new", seq=110), night_row("old", seq=111), night_row("lost", seq=112)], NIGHT)
    ledger = spark.createDataFrame([("old",)], "detail_url string")
    night = nightly.judged(records, seen, ledger)
    urls = lambda df: sorted(r.detail_url for r in df.collect())
    assert urls(night.flips) == ["u5"] and urls(night.restored) == ["old"] and urls(night.new_rows) == ["new"] and urls(night.held_back) == []
    assert [(r.detail_url, r.field, r["from"], r.to) for r in night.changes.collect()] == [("u1", "amount", "$1.00", "$2.00")]
    after = {(r.detail_url, r.status, r.amount) for r in nightly.next_snapshot(records, night).collect()}
    assert ("u5", "Expired", "$1.00") in after and ("old", "Active", "$1.00") in after and ("u1", "Active", "$2.00") in after and ("new", "Active", "$1.00") in after and ("lost", "Expired", "$1.00") in after


def test_amendment_takes_nothing_from_an_expired_twin(spark):
    rows = [night_row(f"u{i}", seq=i, amount="$5.00") for i in range(6)] + [night_row(f"u{i}", seq=20 + i, amount="$3.00", status="Expired") for i in range(6)]
    records = spark.createDataFrame(rows, NIGHT)
    seen = spark.createDataFrame([(*night_row(f"u{i}", seq=50 + i, amount="$5.00")[:4], "Other", *night_row(f"u{i}", amount="$5.00")[5:12], 50 + i) for i in range(6)], NIGHT)
    after = nightly.next_snapshot(records, nightly.judged(records, seen, spark.createDataFrame([], "detail_url string"))).collect()
    assert {(r.status, r.vendor, r.amount) for r in after} == {("Active", "Other", "$5.00"), ("Expired", "V", "$3.00")} and len(after) == 12


def test_refused_entity_keeps_its_new_rows(spark):
    records = spark.createDataFrame([night_row(f"u{i}", seq=i) for i in range(20)], NIGHT)
    seen = spark.createDataFrame([night_row("u0", seq=50), night_row("new", seq=51)], NIGHT)
    night = nightly.judged(records, seen, spark.createDataFrame([], "detail_url string"))
    assert night.flips.count() == 0 and night.new_rows.count() == 1
    assert [r.refusal for r in night.verdicts.collect()] == ["more than half vanished"]


def test_extraction_plan(spark):
    kind = "tok string, data struct<status:string,doc:string,text:string>"
    log = spark.createDataFrame([("a", ("text", "d", "This item involved a direct purchase which did not result in a contract.")), ("b", ("scanned", "d", None)), ("c", ("text", "d", "none"))], kind)
    scoped = extraction.scope(log)
    assert [(r.tok, r.source) for r in scoped.collect()] == [("a", "direct_purchase")]
    assert [tuple(r) for r in extraction.report(scoped).collect()] == [("direct_purchase", 1, 72, 72)]
    assert sorted(tuple(r) for r in extraction.status_tally(log).collect()) == [("scanned", 1), ("text", 2)]
    answers = extraction.summary_results(spark.createDataFrame([("a", "UNCLEAR."), ("b", " fine ")], "tok string, answer string"))
    assert sorted(tuple(r) for r in answers.collect()) == [("a", True, None), ("b", False, "fine")]


def test_long_document_list(spark):
    # Half of the tokens come twice: the first counts. By place and array this took the square of the page's length.
    row = lambda i: f"<tr><td><a href='V/ViewDocument?D=t{i % 10_000}'>n{i} &amp; co</a></td><td>12 KB</td></tr>"
    page = spark.createDataFrame([(1, "".join(row(i * 7) for i in range(20_000)))], "p int, html string")
    began = time.monotonic()
    docs = html.document_list(page).first().documents
    assert [(x.name, x.token) for x in docs] == [(f"n{i * 7} & co", f"t{i * 7 % 10_000}") for i in range(10_000)]
    assert time.monotonic() - began < 60
