"""Queries that write files as the collector leaves them and read them back: logs, record files, pages, snapshots, state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions import predicates as P
from ..functions import search as S
from ..operators import dedup, documents, guards, index, reports, vendors
from ..operators.fold import numbered
from ..sources import html, readers, scratch, snapshots
from ..sources.schemas import RECORD
from . import build
from .catalogue import RECORDS_SQL, query, records, t


def put_log(spark: SparkSession, rows: DataFrame, order: str, last: bytes) -> str:
    """`rows` (value) as a log in the order of a column, and a last file with the given bytes."""
    path = scratch.folder(spark, "log")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(min(parts, 8), order).sortWithinPartitions(order).select("value").write.text(path)
    scratch.put(spark, f"{path}/part-99999-last.txt", last)
    return path


EVENT_LOG = "tok string, event_id long, kind string"


def event_log(spark: SparkSession, d: str, last: bytes) -> str:
    token = F.when(F.col("user_id") % 7 != 0, F.col("user_id").cast("string"))
    line = F.to_json(F.struct(token.alias("tok"), "event_id", F.concat(F.col("event_type"), F.lit(" \u0085|")).alias("kind")))
    return put_log(spark, t(spark, d, "events").select("event_id", line.alias("value")), "event_id", last)


LAST_SQL = "SELECT CAST(user_id AS VARCHAR) AS tok, max(event_id) AS event_id, max_by(event_type, event_id) || chr(8232) || chr(133) || '|' AS kind FROM events WHERE user_id % 7 <> 0 GROUP BY 1"


@query("S3_S5_S7_S9_E1_E2_log_fold", LAST_SQL)
def _(spark, d):
    return readers.folded(spark, event_log(spark, d, b'{"tok":"1","event_id":99999999,"ki'), EVENT_LOG, "tok")


@query("S4_S6_E12_strict_tail", f"WITH l AS ({LAST_SQL}) SELECT 'strict' AS mode, * FROM l UNION ALL SELECT 'lenient', tok, CASE WHEN tok = '1' THEN 99999999 ELSE event_id END, CASE WHEN tok = '1' THEN 'late' ELSE kind END FROM l")
def _(spark, d):
    path = event_log(spark, d, b'{"tok":"1","event_id":99999999,"kind":"late"}')
    read = lambda strict: readers.folded(spark, path, EVENT_LOG, "tok", strict).select(F.lit("strict" if strict else "lenient").alias("mode"), "tok", "event_id", "kind")
    return read(True).unionByName(read(False))


@query("S8_source_texts", "SELECT CAST(user_id AS VARCHAR) AS tok, max_by(event_type || ' ' || event_id, event_id) AS text FROM events WHERE value > 30 AND user_id % 7 <> 0 GROUP BY 1")
def _(spark, d):
    e = t(spark, d, "events")
    text = F.when(F.col("value") > 30, F.concat_ws(" ", "event_type", F.col("event_id").cast("string"))).otherwise(F.when(F.col("event_id") % 2 == 0, "  "))
    line = F.to_json(F.struct(F.when(F.col("user_id") % 7 != 0, F.col("user_id").cast("string")).alias("tok"), F.create_map(F.lit("vision"), F.struct(text.alias("text"))).alias("engines")))
    path = put_log(spark, e.select("event_id", line.alias("value")), "event_id", b"")
    return readers.source_texts(readers.jsonl(spark, path, "tok string, doc string, engines map<string,struct<text:string>>"), "vision").select("tok", "text")


@query("A8_engine_report", """SELECT event_type AS engine, count(*) AS documents, round(100 * count(*) FILTER (value > 50) / count(*), 4) AS described_pct, round(avg(CASE WHEN event_id % 3 > 0 THEN CAST(event_id % 100 AS DOUBLE) END), 6) AS seconds_per_page,
  count(*) FILTER (event_id % 5 = 0) AS failed, round(round(avg(CASE WHEN event_id % 3 > 0 AND event_id % 100 > 0 THEN CAST(event_id % 100 AS DOUBLE) END), 6) * 1000 / 3600, 4) AS hours FROM (SELECT * FROM events WHERE event_id % 3 = 0 OR event_id % 100 > 0) GROUP BY 1""")
def _(spark, d):
    e = t(spark, d, "events").where("event_id % 3 = 0 or event_id % 100 > 0")
    pace = F.when(F.col("event_id") % 3 > 0, F.col("event_id") % 100).otherwise(0).cast("double")
    result = F.struct(pace.alias("seconds_per_page"), (F.col("value") > 50).alias("described"), F.when(F.col("event_id") % 5 == 0, "crash").alias("error"))
    return reports.projected_hours(reports.engines(e.select(F.create_map("event_type", result).alias("engines"))), 1000)


def raw_records(spark: SparkSession, d: str) -> DataFrame:
    """The records as the text columns of a record file; every eleventh has no key, vendors have signs that CSV must quote."""
    r = records(spark, d)
    slash = lambda c: F.when(F.col(c) > 0, F.date_format(N.from_date_int(F.col(c)), "M/d/yyyy")).otherwise("")
    key = F.col("row_id").cast("string")
    url = F.when(F.col("row_id") % 11 == 0, "").otherwise(F.concat(F.lit("https://h/S?A=1&DN="), key, F.lit("&V="), F.col("custkey").cast("string")))
    own = {
        "doc_number": key, "doc_type": F.left("doc_type", F.lit(1)), "entity_code": F.lit("1"), "entity_name": F.col("entity_name"), "vendor": F.concat(F.col("vendor"), F.lit(', "the" firm\n& sons')),
        "amount": F.concat(F.lit("$"), F.format_number("amount_value", 2)), "begin_date": slash("begin"), "end_date": slash("end"), "status": F.col("status"), "detail_url": url, "view_url": F.lit(""),
    }
    return r.select(*[own[c].alias(c) for c in RECORD.names])


def put_records(spark: SparkSession, rows: DataFrame, extra: bytes | None = None) -> str:
    path = scratch.folder(spark, "records")
    rows.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    if extra is not None:
        scratch.put(spark, f"{path}/part-99999-last.csv", (",".join(RECORD.names) + "\n").encode() + extra)
    return path


RAW_SQL = f"""WITH {RECORDS_SQL}, raw AS (
  SELECT doc_number, left(doc_type, 1) AS doc_type, entity_name, vendor || ', "the" firm' || chr(10) || '& sons' AS vendor, round(amount_value, 2) AS amount_value, begin_, end_, status, row_id, custkey,
    CASE WHEN row_id % 11 = 0 THEN '' ELSE 'https://h/S?A=1&DN=' || row_id || '&V=' || custkey END AS detail_url FROM records
)"""


@query("S1_S2_U1_record_files", RAW_SQL + " SELECT CASE WHEN doc_type IN ('1', '2') THEN 'contract' ELSE 'state' END AS dataset, doc_number, vendor, status, detail_url FROM raw WHERE detail_url <> ''")
def _(spark, d):
    raw = raw_records(spark, d)
    paths = {"contract": put_records(spark, raw.where("doc_type in ('1', '2')")), "state": put_records(spark, raw.where("doc_type not in ('1', '2')"))}
    return readers.keyed_records(spark, paths).select("dataset", "doc_number", "vendor", "status", "detail_url")


@query("E3_torn_record_file", RAW_SQL + " SELECT doc_number, entity_name, vendor FROM raw UNION ALL SELECT 'Z-1', 'E', 'V'")
def _(spark, d):
    path = put_records(spark, raw_records(spark, d), b"Z-1,O4,1,E,V,$1,1/2/2024,,Active,u,\nZ-2,O4,1,E,cut o")
    return readers.whole_records(spark, {"state": path}).select("doc_number", "entity_name", "vendor")


GROUPS = {"1": "Contract", "2": "Purchase Order", "_note": "what the codes mean"}


@query("S18_P3_P6_F31_normalised", RAW_SQL + """ SELECT doc_number, CASE doc_type WHEN '1' THEN 'Contract' WHEN '2' THEN 'Purchase Order' ELSE doc_type END AS type_group, amount_value, begin_ AS begin_date, end_ AS end_date, CASE WHEN row_id % 2 = 0 THEN left(sha256(detail_url), 24) ELSE left(md5(doc_number), 24) END AS k,
  CASE WHEN detail_url = '' THEN '' ELSE doc_number END AS dn, CASE WHEN detail_url = '' THEN '' ELSE CAST(custkey AS VARCHAR) END AS v FROM raw""")
def _(spark, d):
    path = scratch.folder(spark, "map")
    scratch.put(spark, path, str(GROUPS).replace("'", '"').encode())
    rows = build.normalised(raw_records(spark, d), readers.reference_map(spark, path))
    key = N.key_hash(F.when(F.col("doc_number").cast("long") % 2 == 0, F.col("detail_url")).otherwise(F.left(F.md5("doc_number"), F.lit(24))))
    return rows.select("doc_number", "type_group", "amount_value", F.col("begin").alias("begin_date"), F.col("end").alias("end_date"), key.alias("k"), F.col("p_dn").alias("dn"), F.col("p_v").alias("v"))


@query("K8_row_lists", RAW_SQL + " SELECT row_id, '[\"' || doc_number || '\",\"' || doc_type || '\",\"' || entity_name || '\",\"' || status || '\"]' AS row FROM raw")
def _(spark, d):
    return build.row_lists(raw_records(spark, d).withColumn("row_id", F.col("doc_number").cast("long")), ["doc_number", "doc_type", "entity_name", "status"])


@query("K10_as_csv", RAW_SQL + " SELECT CASE WHEN row_id % 2 = 0 THEN '''=' ELSE '' END || doc_number AS doc_number, CASE WHEN row_id % 2 = 1 THEN '''@' ELSE '' END || vendor AS vendor, entity_name, '2026-01-02' AS data_as_of FROM raw")
def _(spark, d):
    raw, odd = raw_records(spark, d), F.col("doc_number").cast("long") % 2 == 1
    rows = raw.withColumn("vendor", F.when(odd, F.concat(F.lit("@"), "vendor")).otherwise(F.col("vendor"))).withColumn("doc_number", F.when(odd, F.col("doc_number")).otherwise(F.concat(F.lit("="), "doc_number")))
    return build.as_csv(rows, "2026-01-02").select("doc_number", "vendor", "entity_name", "data_as_of")


def grid_pages(spark: SparkSession, d: str) -> DataFrame:
    """A result page for each customer: a row for each order, and a pager."""
    o = t(spark, d, "orders").withColumn("cells", F.array(
        F.col("o_orderkey").cast("string"), F.left("o_orderpriority", F.lit(1)), F.lit("7"), F.lit("ROADS &amp; <b>BRIDGES</b>"), F.concat(F.lit(" Firm&nbsp;\n"), F.col("o_custkey").cast("string")),
        F.format_string("$%.2f", "o_totalprice"), F.lit("1/2/2024"), F.lit(""),
    ))
    row = F.concat(F.lit("<tr>"), F.array_join(F.transform("cells", lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))), ""), F.lit("<td><a href='/S?A=1&amp;DN="), F.col("o_orderkey").cast("string"), F.lit("'>more</a></td></tr>"))
    pages = o.groupBy(F.col("o_custkey").alias("page")).agg(F.array_join(F.sort_array(F.collect_list(row)), "\n").alias("rows"))
    pager = F.concat(F.lit("<tfoot><tr><td><a href='?s=1&amp;page=2'>2</a> <a href='?page="), (F.col("page") % 90 + 3).cast("string"), F.lit("'>last</a></td></tr></tfoot>"))
    return pages.select("page", F.concat(F.lit("<html><table id='entitygrid'><thead><tr><th>No</th></tr></thead>"), "rows", pager, F.lit("</table></html>")).alias("html"))


@query("S14_html_grid", "SELECT o_custkey AS page, CAST(o_orderkey AS VARCHAR) AS doc_number, 'ROADS & BRIDGES' AS entity_name, 'Firm ' || o_custkey AS vendor, '/S?A=1&DN=' || o_orderkey AS detail_url, CAST(o_custkey % 90 + 3 AS INTEGER) AS last_page FROM orders")
def _(spark, d):
    return html.grid(grid_pages(spark, d)).select("page", "doc_number", "entity_name", "vendor", "detail_url", "last_page")


@query("P21_record_rows", "SELECT CAST(o_orderkey AS VARCHAR) AS doc_number, 'Roads & Bridges' AS entity_name, 'Firm ' || o_custkey AS vendor, 'Expired' AS status, '/S?A=1&DN=' || o_orderkey AS detail_url, '' AS view_url FROM orders")
def _(spark, d):
    entities = spark.createDataFrame([("Roads & Bridges",), ("Parks",)], "entity_name string")
    return html.record_rows(html.grid(grid_pages(spark, d)), entities, "Expired").select("doc_number", "entity_name", "vendor", "status", "detail_url", "view_url")


def file_pages(spark: SparkSession, d: str) -> DataFrame:
    """A page for each part size with a file for each part, some twice; one page has no file and one couldn't be read."""
    p = t(spark, d, "part").withColumn("tok", F.concat(F.lit("t"), (F.col("p_partkey") % 97).cast("string")))
    row = F.concat(F.lit("<tr><td><a href='V/ViewDocument?D="), "tok", F.lit("' class='x'>"), "p_name", F.lit(" &amp;\n<i>co</i></a></td><td> 12&nbsp;KB</td></tr>"))
    pages = p.groupBy(F.col("p_size").cast("long").alias("page")).agg(F.concat_ws("\n", F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", row.alias("r")))), lambda x: x["r"])).alias("html"))
    other = spark.createDataFrame([(-1, "<p>none</p>"), (-2, None)], "page long, html string")
    return pages.unionByName(other)


FILES_SQL = """WITH f AS (SELECT p_size AS page, p_partkey, p_name || ' & co' AS name, 't' || (p_partkey % 97) AS tok FROM part), first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page, tok ORDER BY p_partkey) AS k FROM f) WHERE k = 1)"""


@query("S15_X9_document_lists", FILES_SQL + """, n AS (SELECT CAST(page AS BIGINT) AS page, count(*) AS n, string_agg(name || '|12 KB|' || tok, ';' ORDER BY p_partkey) AS files FROM first GROUP BY 1) SELECT page, CAST(n AS INTEGER) AS n, files FROM n UNION ALL SELECT -1, 0, '' UNION ALL SELECT -2, NULL, NULL""")
def _(spark, d):
    docs = html.document_list(file_pages(spark, d))
    line = F.transform("documents", lambda x: F.concat_ws("|", x["name"], x["size"], x["token"]))
    return docs.select("page", F.when(F.col("documents").isNotNull(), F.size("documents")).alias("n"), F.array_join(line, ";").alias("files"))


@query("P22_F18_log_entries", FILES_SQL + """, n AS (SELECT CAST(page AS BIGINT) AS page, count(*) AS n, min_by(tok, p_partkey) AS head, string_agg(tok, ';' ORDER BY p_partkey) AS toks FROM first GROUP BY 1) SELECT page, CAST(n AS INTEGER) AS n, CASE WHEN n > 1 THEN toks END AS kept, head FROM n UNION ALL SELECT -1, 0, NULL, ''""")
def _(spark, d):
    docs = html.document_list(file_pages(spark, d)).where("documents is not null").withColumn("n", F.size("documents"))
    kept = documents.log_entry(F.col("n"), F.col("documents"))
    return docs.select("page", "n", F.array_join(documents.own_tokens(kept), ";").alias("kept"), documents.first_token(F.col("documents")).alias("head"))


@query("S16_html_options", "SELECT n_name || ' & co' AS name, CAST(n_nationkey AS VARCHAR) AS value FROM nation WHERE n_nationkey <> 4")
def _(spark, d):
    option = F.concat(F.lit("<option class='o' value='"), F.when(F.col("n_nationkey") == 4, "ALL-999-000").otherwise(F.col("n_nationkey").cast("string")), F.lit("'>\n"), "n_name", F.lit(" &amp; co</option>"))
    page = t(spark, d, "nation").agg(F.concat(F.lit("<select><option value=''>all</option>"), F.array_join(F.collect_list(option), ""), F.lit("</select>")).alias("html"))
    return html.options(page)


@query("S17_F20_content_verdict", r"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'unsupported' WHEN 1 THEN 'unsupported' ELSE 'error' END AS status, sha256(html) AS sha256, left(trim(regexp_replace(left(html, 2000), '[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')), 300) AS head FROM pages""")
def _(spark, d):
    kind = F.element_at(F.array(*map(F.lit, ["image/TIFF", "application/vnd.ms-excel", "text/html"]), F.lit(None).cast("string")), (F.col("page_id") % 4 + 1).cast("int"))
    return t(spark, d, "pages").select("page_id", P.non_pdf_verdict(kind, F.encode("html", "UTF-8")).alias("v")).select("page_id", "v.status", "v.sha256", "v.head")


@query("S20_O8_X16_release_asset", """WITH r AS (SELECT DISTINCT p_brand AS tag FROM part), w(wanted, tag) AS (SELECT 'Brand#2', CASE WHEN EXISTS (SELECT 1 FROM r WHERE tag = 'Brand#2') THEN 'Brand#2' END UNION ALL SELECT 'Brand', max(tag) FROM r)
SELECT wanted, w.tag, 'data.zip' AS name, count(*) AS size FROM w JOIN part ON p_brand = w.tag GROUP BY ALL""")
def _(spark, d):
    p = t(spark, d, "part")
    releases = p.select(F.col("p_brand").alias("tag")).distinct()
    files = p.groupBy(F.col("p_brand").alias("tag")).agg(F.count("*").alias("size")).select("tag", F.explode(F.array(F.lit("data.zip"), F.lit("notes.txt"))).alias("name"), "size")
    one = lambda wanted: readers.asset(releases, files, wanted, "data.zip").select(F.lit(wanted).alias("wanted"), "tag", "name", "size")
    return one("Brand#2").unionByName(one("Brand"))


def snapshot(spark: SparkSession, d: str) -> snapshots.Store:
    """A published build over an older one: records in blocks with provenance, a word index, descriptions apart."""
    store = snapshots.Store(spark, scratch.folder(spark, "store"))
    rows = numbered(records(spark, d).drop("row_id"), ["doc_number"])
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("row_id"), "text", (F.col("doc_id") % 3).cast("int").alias("source"), F.when(F.col("doc_id") % 5 > 0, F.col("doc_id") % 5).cast("int").alias("position"))
    for old in (True, False):
        name = store.new_build()
        store.write(name, "records", snapshots.in_blocks(rows.where("amount_value > 100000") if old else rows), by=["block"])
        if not old:
            store.write(name, "descriptions", docs)
            words = index.postings(docs, "text")
            store.write(name, "index", words, sort=["word", "row_id"])
            store.verify(name, "descriptions", docs, ["row_id", "text", "source"])
            store.verify(name, "index", words)
        store.seal(name)
        store.publish(name)
    return store


ROWS_SQL = f"WITH {RECORDS_SQL}, r AS (SELECT *, row_number() OVER (ORDER BY doc_number) - 1 AS rid FROM records)"


@query("K1_K2_K7_S10_S11_W3_snapshot", ROWS_SQL + " SELECT rid AS row_id, doc_number, amount_value, CAST(rid // 2048 AS INTEGER) AS block FROM r")
def _(spark, d):
    return snapshot(spark, d).checked("records").select("row_id", "doc_number", "amount_value", F.col("block").cast("int").alias("block"))


@query("K3_K12_S12_X3_X5_provenance", ROWS_SQL + """ SELECT rid AS row_id, doc_number, length(text) AS chars, CAST(doc_id % 3 AS INTEGER) AS source, CASE WHEN doc_id % 5 > 0 THEN CAST(doc_id % 5 AS INTEGER) END AS position FROM r LEFT JOIN documents ON doc_id = rid""")
def _(spark, d):
    # Enrichment stands in its own table; a row without it is unknown, not empty.
    store = snapshot(spark, d)
    return store.checked("records").join(store.checked("descriptions"), "row_id", "left").select("row_id", "doc_number", F.length("text").alias("chars"), "source", "position")


@query("K4_S13_F26_index_scan", """WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents) SELECT doc_id AS row_id FROM w WHERE word = 'the' INTERSECT SELECT doc_id FROM w WHERE word LIKE 'an%'""")
def _(spark, d):
    return S.lookup(snapshot(spark, d).checked("index"), ["the"], ["an"])


@query("K11_retired_builds", "SELECT 2 AS before, 1 AS retired, 1 AS after, true AS current_stays, true AS bad_pointer_refused")
def _(spark, d):
    store = snapshots.Store(spark, scratch.folder(spark, "store"))
    names = []
    for k in range(2):
        names.append(store.new_build())
        store.write(names[k], "nation", t(spark, d, "nation").where(f"n_nationkey >= {k}"))
        store.publish(names[k])
    before, retired = len(store.builds()), len(store.prune())
    stays = store.current() == names[1] and store.read("nation").count() == 24
    store.publish("gone")
    return spark.createDataFrame([(before, retired, len(store.builds()), stays, refused(store.prune))], "before int, retired int, after int, current_stays boolean, bad_pointer_refused boolean")


@query("K6_X7_X8_appended_log", "SELECT n_regionkey, n_name, n_nationkey % 2 AS batch FROM nation")
def _(spark, d):
    path = scratch.folder(spark, "log")
    for k in range(2):
        snapshots.append_json(t(spark, d, "nation").where(f"n_nationkey % 2 = {k}").select("n_regionkey", "n_name", F.lit(k).alias("batch")), path)
    return readers.jsonl(spark, path, "n_regionkey int, n_name string, batch int").drop("seq")


@query("K5_X1_vendor_shards", """SELECT CASE WHEN regexp_matches(upper(left(trim(v), 1)), '^[A-Z]$') THEN upper(left(trim(v), 1)) ELSE '_' END AS shard, trim(v) AS vendor, p_partkey FROM (SELECT *, CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN ' ' || p_name || ' ' WHEN 2 THEN '3M ' || p_name ELSE p_name END AS v FROM part) WHERE trim(v) <> ''""")
def _(spark, d):
    k, name = F.col("p_partkey") % 5, F.col("p_name")
    rows = t(spark, d, "part").withColumn("v", F.when(k == 0, "").when(k == 1, F.concat(F.lit(" "), name, F.lit(" "))).when(k == 2, F.concat(F.lit("3M "), name)).otherwise(name))
    path = scratch.folder(spark, "shards")
    # A shard that is gone goes from disk, too.
    for part in (rows.withColumn("v", F.concat(F.lit("Z"), "v")), rows):
        snapshots.vendor_shards(vendors.shards(part, ["p_partkey"], "v", "p_partkey"), path)
    return spark.read.schema("shard string, vendor string, p_partkey long").json(path).select("shard", "vendor", "p_partkey")


STATE = "entity string, page int"


@query("K13_ST11_ST12_E9_E13_X13_state", "SELECT n_name AS entity, n_nationkey AS page, 'kept' AS case FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT 'absent', 0, 'no rows' UNION ALL SELECT 'broken', 0, 'set aside'")
def _(spark, d):
    path = scratch.folder(spark, "state")
    # Progress of a day stands under its date: another day's is no progress.
    today = t(spark, d, "nation").select(F.when(F.col("n_nationkey") % 3 == 0, "2026-01-02").otherwise("2026-01-01").alias("day"), F.col("n_name").alias("entity"), F.col("n_nationkey").alias("page"))
    today.write.partitionBy("day").json(path)
    kept = readers.state(spark, f"{path}/day=2026-01-02", STATE).withColumn("case", F.lit("kept"))
    scratch.put(spark, f"{path}/bad.json", b"{no")
    absent, broken = readers.state(spark, f"{path}/day=2026-01-03", STATE).count(), readers.state(spark, f"{path}/bad.json", STATE).count()
    aside = readers.jsonl(spark, f"{path}/bad.json.corrupt", STATE).count() == 0 and readers.state(spark, f"{path}/bad.json", STATE).count() == 0
    found = spark.createDataFrame([("absent", absent, "no rows"), ("broken", broken, "set aside" if aside else "left")], "entity string, page int, case string")
    return kept.unionByName(found)


def refused(action: Callable[[], object]) -> bool:
    """Whether something fails as its rule asks."""
    try:
        action()
    except Exception:  # the rules raise here or in a task: either way as an error of the action
        return True
    return False


REFUSALS = ["E1 broken line", "E3 open quote", "P5 view URL", "P7 record rules", "A17 ambiguous rows", "E5 unknown model", "E6 stale spelling", "E7 other rows on disk", "E14 missing column", "E8 fewer rows on disk", "E10 odd tokens", "E11 shrinking release", "ST13 unaccounted rows", "X11 empty table"]


@query("E1_E3_E5_E6_E7_E8_E10_E11_E14_E15_P5_P7_ST13_X11_refusals", " UNION ALL ".join(f"SELECT '{x}' AS rule, false AS good_refused, true AS bad_refused" for x in REFUSALS))
def _(spark, d):
    """Each rule on what it must let through and on what it must refuse, both made of the tables."""
    n, orders = t(spark, d, "nation"), t(spark, d, "orders")
    line = orders.select("o_orderkey", F.to_json(F.struct(F.col("o_orderpriority").alias("tok"))).alias("value"))
    log = lambda bad: readers.jsonl(spark, put_log(spark, line.withColumn("value", F.when((F.col("o_orderkey") == 7) & F.lit(bad), '{"tok"').otherwise(F.col("value"))), "o_orderkey", b""), "tok string").agg(F.max("tok")).collect()
    raw = raw_records(spark, d)
    files = lambda bad: readers.whole_records(spark, {"state": put_records(spark, raw.where("doc_type = '1'"), b'Z,O4,1,E,"open' if bad else b"Z,O4,1,E,V,$1,,,Active,u,\n")}).count()
    views = lambda bad: n.select(N.view_suffix(F.concat(F.lit("http://h/" if bad else "https://h/"), "n_name"), "https://h/").alias("v")).agg(F.max("v")).collect()
    rows = raw.withColumn("row", F.lit(1))
    rules = lambda bad: build.checked(rows.where("detail_url <> ''").withColumn("view_url", F.lit("x")), [r.n_name for r in n.where("n_nationkey > 3" if bad else "true").collect()])
    twice = rows.where("detail_url <> ''").withColumn("entity_name", F.lit("E")).withColumn("doc_type", F.lit("x"))
    unclear = lambda bad: build.checked(twice.unionByName(twice) if bad else twice, ["E"])
    places = n.select(F.col("n_name").alias("token"), F.col("n_nationkey").alias("row_id"), F.lit(0).alias("position"))
    answers = n.select(F.col("n_name").alias("tok"), F.lit("m1").alias("model"), F.lit("s").alias("summary"), F.lit(False).alias("unclear"), F.col("n_nationkey").alias("seq"))
    told = lambda bad: documents.summarised(places.select("row_id", F.col("token").alias("view_token")), places, answers, ["m2"] if bad else ["m1", "m2"]).collect()

    def spelling(bad: bool) -> None:
        groups = n.select(F.col("n_name").alias("spelling"), F.lit("x").alias("canonical"))
        if not vendors.stale_spellings(n.where("n_nationkey > 2" if bad else "true").select(F.col("n_name").alias("vendor")), groups).isEmpty():
            raise ValueError("reviewed spellings that no row has")

    def disk(how: str) -> Callable[[bool], object]:
        def run(bad: bool) -> object:
            store = snapshots.Store(spark, scratch.folder(spark, "store"))
            name = store.new_build()
            store.write(name, "n", n)
            store.seal(name)
            if how == "E7":
                return store.verify(name, "n", n.where("n_nationkey <> 1") if bad else n)
            if how == "E14":
                return store.verify(name, "n", n, ["n_name", "missing"] if bad else ["n_name"])
            if bad:
                store.write(name, "n", n.where("n_nationkey <> 1"))
            return store.checked("n", name)

        return run

    def odd(bad: bool) -> None:
        if guards.too_many_odd(orders, F.col("o_orderkey") % (900 if bad else 1_000_000) == 1).first().abort:
            raise ValueError("too many odd tokens")

    def release(bad: bool) -> None:
        old = t(spark, d, "documents").select(F.col("doc_id").alias("tok"), "text")
        if not reports.regression(old, old.where("tok > 3") if bad else old).isEmpty():
            raise ValueError("the release would shrink")

    def left(bad: bool) -> object:
        many = spark.range(3000).join(orders.agg(F.count("*").alias("n")))
        return guards.unfinished(many, many.where("id >= 1500" if bad else "id >= 500"), "id")

    def filled(bad: bool) -> None:
        if raw.where("doc_number = '-'" if bad else "true").isEmpty():
            raise ValueError("no records")

    made = [log, files, views, rules, unclear, told, spelling, disk("E7"), disk("E14"), disk("E8"), odd, release, left, filled]
    found = [(name, refused(lambda f=f: f(False)), refused(lambda f=f: f(True))) for name, f in zip(REFUSALS, made, strict=True)]
    return spark.createDataFrame(found, "rule string, good_refused boolean, bad_refused boolean")
