"""Queries over the driver's tables, each with the SQL that says the same.

The records view gives the orders the shape of published records: a document number, a type, an entity, a vendor, an
amount, two dates and a status. Every query runs over its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions import predicates as P
from ..functions import search as S
from ..functions.parsers import described
from ..operators import dedup, diff, documents, fold, guards, index, reports, vendors
from ..sources import html
from ..sources.schemas import RECORD

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def records(spark: SparkSession, d: str) -> DataFrame:
    """order rows as records; end is the latest ship date."""
    ships = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("last_ship"))
    o = t(spark, d, "orders").join(ships, "o_orderkey", "left")
    c = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    both = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    ymd = lambda x: F.coalesce(F.date_format(x, "yyyyMMdd").cast("long"), F.lit(0).cast("long"))
    return both.select(
        F.col("o_orderkey").cast("string").alias("doc_number"), F.col("o_orderpriority").alias("doc_type"), F.col("n_name").alias("entity_name"), F.col("c_name").alias("vendor"), F.col("o_totalprice").alias("amount_value"),
        ymd("o_orderdate").alias("begin"), ymd("last_ship").alias("end"), F.when(F.col("o_orderstatus") == "F", "Expired").otherwise("Active").alias("status"), F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("custkey"),
    )


RECORDS_SQL = """records AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS doc_number, o_orderpriority AS doc_type, n_name AS entity_name, c_name AS vendor, o_totalprice AS amount_value,
    CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS begin_, coalesce(CAST(strftime(last_ship, '%Y%m%d') AS BIGINT), 0) AS end_,
    CASE WHEN o_orderstatus = 'F' THEN 'Expired' ELSE 'Active' END AS status, o_orderkey AS row_id, o_custkey AS custkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) s ON s.l_orderkey = o_orderkey
)"""
AS_OF = "1996-06-30"


@query("D01_spend_by_vendor", """SELECT c_name AS vendor, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE trim(c_name) <> '' GROUP BY 1""")
def _(spark, d):
    rows = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_name").alias("vendor"), F.col("o_totalprice").alias("amount_value"))
    return vendors.spend(rows)


@query("D02_money_parse", """SELECT o_orderkey, round(coalesce(try_cast(regexp_replace('$ ' || CAST(o_totalprice AS VARCHAR), '[$,\\s]', '', 'g') AS DOUBLE), 0.0), 2) AS amount FROM orders""")
def _(spark, d):
    return t(spark, d, "orders").select("o_orderkey", N.money(F.concat(F.lit("$ "), F.col("o_totalprice").cast("string"))).alias("amount"))


@query("D03_date_int", """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS ymd FROM orders""")
def _(spark, d):
    return t(spark, d, "orders").select("o_orderkey", N.date_int(F.date_format("o_orderdate", "M/d/yyyy")).alias("ymd"))


@query("D04_dedup_first", """SELECT l_orderkey, l_suppkey, l_returnflag, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey, l_returnflag ORDER BY l_linenumber, l_partkey) AS k FROM lineitem) WHERE k = 1""")
def _(spark, d):
    rows = t(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag", "l_linenumber", "l_partkey").withColumn("seq", F.struct("l_linenumber", "l_partkey"))
    return fold.first(rows, ["l_orderkey", "l_suppkey", "l_returnflag"], "seq").drop("seq")


@query("D05_fold_latest", """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def _(spark, d):
    e = t(spark, d, "events").withColumn("seq", F.struct("ts", "event_id"))
    return fold.latest(e, ["user_id"], "seq").select("user_id", "event_id", "event_type", "value")


@query("D06_twin_anti", """SELECT o_orderkey FROM orders o WHERE o_orderstatus <> 'F' OR NOT EXISTS (SELECT 1 FROM orders a WHERE a.o_orderstatus <> 'F' AND a.o_custkey = o.o_custkey AND a.o_orderpriority = o.o_orderpriority)""")
def _(spark, d):
    rows = t(spark, d, "orders").withColumn("status", F.when(F.col("o_orderstatus") == "F", "Expired").otherwise("Active"))
    return dedup.without_twins(rows, ["o_custkey", "o_orderpriority"]).select("o_orderkey")


@query("J3_stale_anti", """SELECT o_orderkey FROM orders o WHERE o_orderstatus <> 'F' OR NOT EXISTS (SELECT 1 FROM orders a WHERE a.o_orderstatus <> 'F' AND a.o_custkey = o.o_custkey)""")
def _(spark, d):
    rows = t(spark, d, "orders").withColumn("status", F.when(F.col("o_orderstatus") == "F", "Expired").otherwise("Active")).withColumn("detail_url", F.col("o_custkey").cast("string"))
    return dedup.without_stale(rows).select("o_orderkey")


@query("D07_left_unknown", """SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l USING (doc_id)""")
def _(spark, d):
    log = t(spark, d, "labels").select("doc_id", F.col("quality").alias("n"), F.lit(None).cast("string").alias("documents"))
    return documents.with_counts(t(spark, d, "documents").select("doc_id"), log, "doc_id").select("doc_id", F.col("n").alias("quality"))


KEY_SQL = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper({0}), '[\s.,#-]*\d[\d\s.-]*$', ' '), '\b(INC|INCORPORATED|LLC|L L C|LLP|LTD|CO|CORP|CORPORATION|COMPANY|COMPANIES|THE|OF|AND|DBA|PC|PLLC|LP)\b', ' ', 'g'), '[^A-Z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"""


@query("D08_vendor_key", f"SELECT DISTINCT name, {KEY_SQL.format('name')} AS key FROM (SELECT p_name AS name FROM part UNION ALL SELECT s_name FROM supplier UNION ALL SELECT c_name FROM customer)")
def _(spark, d):
    names = t(spark, d, "part").select(F.col("p_name").alias("name")).union(t(spark, d, "supplier").select("s_name")).union(t(spark, d, "customer").select("c_name")).distinct()
    return names.select("name", N.vendor_key(F.col("name")).alias("key"))


@query(
    "D09_vendor_clusters",
    f"""WITH spent AS (SELECT p_name || ' ' || CAST(p_size AS VARCHAR) AS vendor, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n FROM part GROUP BY 1)
SELECT key, count(*) AS spellings, CAST(sum(CAST(total AS DECIMAL(38,2))) AS DOUBLE) AS total, list(vendor ORDER BY total DESC, vendor) AS members
FROM (SELECT *, {KEY_SQL.format('vendor')} AS key FROM spent) WHERE key <> '' GROUP BY key HAVING count(*) >= 2""",
)
def _(spark, d):
    p = t(spark, d, "part").select(F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("vendor"), F.col("p_retailprice").alias("amount_value"))
    return vendors.clusters(vendors.spend(p))


@query("A03_at_stake", f"""WITH spent AS (SELECT p_name || ' ' || CAST(p_size AS VARCHAR) AS vendor, sum(CAST(p_retailprice AS DECIMAL(18,2))) AS total FROM part GROUP BY 1), g AS (SELECT sum(total) AS s FROM (SELECT *, {KEY_SQL.format('vendor')} AS key FROM spent) WHERE key <> '' GROUP BY key HAVING count(*) >= 2)
SELECT round(CAST(coalesce(sum(s), 0) AS DOUBLE), 2) AS at_stake, count(*) AS clusters FROM g""")
def _(spark, d):
    return vendors.at_stake(QUERIES["D09_vendor_clusters"](spark, d))


@query("D10_collision", f"""WITH {RECORDS_SQL} SELECT doc_type, entity_name, begin_, count(*) AS n, count(DISTINCT vendor) AS destinations FROM records GROUP BY ALL HAVING count(*) > 1 AND count(DISTINCT vendor) > 1""")
def _(spark, d):
    return dedup.collisions(records(spark, d).withColumnRenamed("begin", "begin_"), ["doc_type", "entity_name", "begin_"], "vendor")


@query("D11_index_stats", """SELECT word, count(*) AS n, min(doc_id) AS first_row, max(doc_id) AS last_row FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents) WHERE length(word) >= 2 GROUP BY word""")
def _(spark, d):
    return index.word_stats(index.postings(t(spark, d, "documents"), "text", "doc_id"))


@query("D12_index_prefix", """WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents) SELECT doc_id AS row_id FROM w WHERE word = 'the' INTERSECT SELECT doc_id FROM w WHERE word = 'and' INTERSECT SELECT doc_id FROM w WHERE word LIKE 'thing%'""")
def _(spark, d):
    return S.lookup(index.postings(t(spark, d, "documents"), "text", "doc_id"), ["the", "and"], ["thing"])


@query("D13_snapshot_diff", """WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < DATE '1996-01-01'), b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= DATE '1996-01-01')
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, CASE WHEN a.o_custkey IS NULL THEN 'new' WHEN b.o_custkey IS NULL THEN 'vanished' ELSE 'kept' END AS change FROM a FULL JOIN b ON a.o_custkey = b.o_custkey""")
def _(spark, d):
    o = t(spark, d, "orders")
    return diff.keys_diff(o.where("o_orderdate < '1996-01-01'"), o.where("o_orderdate >= '1996-01-01'"), ["o_custkey"])


@query("D14_guard_refusal", f"""WITH {RECORDS_SQL}, per AS (SELECT doc_type AS dataset, entity_name AS entity, count(*) AS known, count(*) FILTER (status = 'Active') AS seen, count(*) FILTER (status = 'Expired') AS vanished, count(*) FILTER (amount_value > 200000) AS strays, count(*) AS listed FROM records GROUP BY ALL)
SELECT *, CASE WHEN known >= 5 AND seen = 0 THEN 'nothing seen' WHEN known >= 20 AND vanished * 2 > known THEN 'more than half vanished' END AS refusal, strays >= 5 AND strays * 20 > listed AS leak,
  sum(known) OVER w >= 50 AND sum(vanished) OVER w * 2 > sum(known) OVER w AS breaker, sum(strays) OVER w >= 5 AND sum(strays) OVER w * 20 > sum(listed) OVER w AS dataset_leak FROM per WINDOW w AS (PARTITION BY dataset)""")
def _(spark, d):
    per = records(spark, d).groupBy(F.col("doc_type").alias("dataset"), F.col("entity_name").alias("entity")).agg(
        F.count("*").alias("known"), F.count_if(F.col("status") == "Active").alias("seen"), F.count_if(F.col("status") == "Expired").alias("vanished"), F.count_if(F.col("amount_value") > 200000).alias("strays"), F.count("*").alias("listed")
    )
    return guards.verdicts(per)


@query("D15_field_changes", """SELECT c_custkey AS key, u.field, u."from", u."to" FROM customer, LATERAL (VALUES ('c_mktsegment', c_mktsegment, CASE WHEN c_custkey % 3 = 0 THEN 'OTHER' ELSE c_mktsegment END), ('c_nationkey', CAST(c_nationkey AS VARCHAR), CAST(CASE WHEN c_custkey % 5 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS VARCHAR))) u(field, "from", "to") WHERE u."from" <> u."to" """)
def _(spark, d):
    base = t(spark, d, "customer").select(F.col("c_custkey").alias("key"), "c_mktsegment", "c_nationkey")
    fresh = base.withColumn("c_mktsegment", F.when(F.col("key") % 3 == 0, "OTHER").otherwise(F.col("c_mktsegment"))).withColumn("c_nationkey", F.when(F.col("key") % 5 == 0, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")))
    return diff.field_changes(base, fresh, "key", ["c_mktsegment", "c_nationkey"])


@query("D16_streaks", """WITH n AS (SELECT user_id, CAST(ts AS DATE) AS night, bool_or(event_type = 'error') AS leaked FROM events GROUP BY 1, 2), c AS (SELECT user_id, max(night) AS clean FROM n WHERE NOT leaked GROUP BY 1)
SELECT n.user_id, count(*) AS nights, max(night) AS last FROM n LEFT JOIN c USING (user_id) WHERE leaked AND (clean IS NULL OR night > clean) GROUP BY 1""")
def _(spark, d):
    e = t(spark, d, "events").select("user_id", F.to_date("ts").alias("night"), (F.col("event_type") == "error").alias("leaked"))
    return guards.streaks(e, "user_id")


@query("W12_islands", """WITH m AS (SELECT user_id, event_id, event_type, sum(CASE WHEN event_type = 'click' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS run FROM events) SELECT user_id, min(event_id) AS run_start, max(event_id) AS run_end, count(*) AS length FROM m WHERE event_type = 'click' GROUP BY user_id, run""")
def _(spark, d):
    return fold.islands(t(spark, d, "events"), ["user_id"], ["event_id"], F.col("event_type") == "click")


@query("W05_out_of_order", """SELECT user_id, event_id, value, floor_ AS floor FROM (SELECT *, min(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS floor_ FROM events) WHERE value > floor_""")
def _(spark, d):
    return fold.running_violations(t(spark, d, "events").select("user_id", "event_id", "value"), ["user_id"], ["event_id"], "value")


@query("D17_best_by_rank", """SELECT source, doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE lang WHEN 'de' THEN 0 WHEN 'fr' THEN 1 ELSE 2 END, doc_id DESC) AS k FROM documents) WHERE k = 1""")
def _(spark, d):
    rank = F.when(F.col("lang") == "de", 0).when(F.col("lang") == "fr", 1).otherwise(2)
    return fold.best_by_rank(t(spark, d, "documents").select("source", "doc_id", "lang", rank.alias("rank")), ["source"], "rank", "doc_id").select("source", "doc_id", "lang")


@query("D18_first_seen_index", """SELECT event_type, min(event_id) AS first_seq, row_number() OVER (ORDER BY min(event_id)) - 1 AS idx FROM events GROUP BY 1""")
def _(spark, d):
    return fold.first_seen_index(t(spark, d, "events"), "event_type", "event_id")


@query("W02_row_ids", """SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS row_id, (row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1) // 2048 AS block FROM orders""")
def _(spark, d):
    from ..sources.snapshots import in_blocks

    return in_blocks(fold.numbered(t(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")])).select("o_orderkey", "row_id", "block")


@query("D19_coverage_gap", """SELECT n_name AS entity, s AS status FROM nation, (VALUES ('O'), ('F'), ('P')) v(s) EXCEPT SELECT n_name, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice > 498000""")
def _(spark, d):
    big = t(spark, d, "orders").where("o_totalprice > 498000").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return diff.coverage_gap(t(spark, d, "nation").select(F.col("n_name").alias("entity")), ["O", "F", "P"], big.select(F.col("n_name").alias("entity"), F.col("o_orderstatus").alias("status")))


@query("D20_drift", """WITH a AS (SELECT n_name AS key, n_regionkey AS value FROM nation WHERE n_nationkey < 20), b AS (SELECT n_name AS key, CASE WHEN n_nationkey = 10 THEN 9 ELSE n_regionkey END AS value FROM nation WHERE n_nationkey > 4)
SELECT coalesce(a.key, b.key) AS key, CASE WHEN a.key IS NULL THEN 'added' WHEN b.key IS NULL THEN 'removed' ELSE 'changed' END AS change, a.value AS old_value, b.value AS new_value FROM a FULL JOIN b ON a.key = b.key WHERE a.key IS NULL OR b.key IS NULL OR a.value <> b.value""")
def _(spark, d):
    n = t(spark, d, "nation")
    return diff.mapping_drift(n.where("n_nationkey < 20").select(F.col("n_name").alias("key"), F.col("n_regionkey").alias("value")), n.where("n_nationkey > 4").select(F.col("n_name").alias("key"), F.when(F.col("n_nationkey") == 10, 9).otherwise(F.col("n_regionkey")).alias("value")))


@query("D21_source_counts", """WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1), k(code, source) AS (VALUES (1, 'en'), (2, 'fr'), (3, 'xx')), m AS (SELECT code, source, coalesce(n, 0) AS n FROM k LEFT JOIN c ON c.lang = k.source)
SELECT CAST(code AS BIGINT) AS code, source, n FROM m UNION ALL SELECT 0, 'none', (SELECT count(*) FROM documents) - (SELECT CAST(sum(n) AS BIGINT) FROM m)""")
def _(spark, d):
    return documents.source_counts(t(spark, d, "documents"), "lang", ["none", "en", "fr", "xx"])


@query("D22_upper_median", """SELECT lang, count(*) AS n, list_sort(list(n_chars))[count(*) // 2 + 1] AS median, max(n_chars) AS longest FROM documents GROUP BY 1""")
def _(spark, d):
    return reports.extraction(t(spark, d, "documents"), "lang", "n_chars")


@query("D23_ratio_report", """SELECT l_linestatus, l_returnflag, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (PARTITION BY l_linestatus), 4) AS pct FROM lineitem GROUP BY 1, 2""")
def _(spark, d):
    return reports.shares(t(spark, d, "lineitem"), ["l_linestatus"], "l_returnflag")


@query("D24_shard_letter", """SELECT CASE WHEN regexp_matches(upper(left(trim(p_name), 1)), '^[A-Z]$') THEN upper(left(trim(p_name), 1)) ELSE '_' END AS shard, trim(p_name) AS vendor, p_partkey, p_brand FROM part WHERE trim(p_name) <> ''""")
def _(spark, d):
    return vendors.shards(t(spark, d, "part"), ["p_partkey", "p_brand"], "p_name", "p_partkey")


@query("D25_shard_md5", """SELECT doc_id, CAST(('0x' || right(md5(CAST(doc_id AS VARCHAR)), 8))::BIGINT % 4 AS INTEGER) AS shard FROM documents""")
def _(spark, d):
    return t(spark, d, "documents").select("doc_id", N.shard_of(F.col("doc_id").cast("string"), 4).alias("shard"))


@query("D26_rel_windows", f"""WITH {RECORDS_SQL} SELECT row_id, strptime(CAST(begin_ AS VARCHAR), '%Y%m%d')::DATE BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}' AS began30, strptime(CAST(begin_ AS VARCHAR), '%Y%m%d')::DATE BETWEEN DATE '{AS_OF}' - 90 AND DATE '{AS_OF}' AS began90,
  coalesce(try_strptime(CAST(end_ AS VARCHAR), '%Y%m%d')::DATE BETWEEN DATE '{AS_OF}' AND DATE '{AS_OF}' + 30, false) AS ends30, coalesce(try_strptime(CAST(end_ AS VARCHAR), '%Y%m%d')::DATE BETWEEN DATE '{AS_OF}' AND DATE '{AS_OF}' + 90, false) AS ends90,
  coalesce(try_strptime(CAST(end_ AS VARCHAR), '%Y%m%d')::DATE BETWEEN DATE '{AS_OF}' AND DATE '{AS_OF}' + 180, false) AS ends180 FROM records""")
def _(spark, d):
    r, day = records(spark, d), F.lit(AS_OF).cast("date")
    return r.select("row_id", *[P.in_window(w, F.col("begin"), F.col("end"), day).alias(w) for w in ("began30", "began90", "ends30", "ends90", "ends180")])


@query("D27_oddities", f"""WITH {RECORDS_SQL}, o AS (SELECT row_id, amount_value - 100000 AS a, CASE WHEN row_id % 50 = 0 THEN 18500101 ELSE begin_ END AS b, CASE row_id % 40 WHEN 0 THEN 20991231 WHEN 1 THEN 99991231 WHEN 2 THEN 22230101 WHEN 3 THEN 0 WHEN 4 THEN 19950101 ELSE end_ END AS e FROM records)
SELECT row_id, a < 0 AS negative, b > 0 AND e > 0 AND b > e AS reversed, (b > 0 AND (b // 10000 < 1900 OR b // 10000 > 2100)) OR (e > 0 AND (e // 10000 < 1900 OR e // 10000 > 2100) AND e NOT IN (20991231, 20990101, 99991231)) AS odd_year, e IN (20991231, 20990101, 99991231) AS open_ended FROM o""")
def _(spark, d):
    r, k = records(spark, d), F.col("row_id")
    begin = F.when(k % 50 == 0, 18500101).otherwise(F.col("begin"))
    end = F.when(k % 40 == 0, 20991231).when(k % 40 == 1, 99991231).when(k % 40 == 2, 22230101).when(k % 40 == 3, 0).when(k % 40 == 4, 19950101).otherwise(F.col("end"))
    return r.select("row_id", *[v.alias(x) for x, v in P.oddities(F.col("amount_value") - 100000, begin, end).items()])


@query("P09_bounds", f"""WITH {RECORDS_SQL} SELECT row_id FROM records WHERE (begin_ = 0 OR begin_ BETWEEN 19950101 AND 19961231) AND amount_value >= 150000""")
def _(spark, d):
    r = records(spark, d)
    return r.where(P.in_years(F.col("begin"), 1995, 1996) & P.in_amounts(F.col("amount_value"), N.bound(F.lit("$150,000")), N.bound(F.lit("many")))).select("row_id")


@query("D28_topk_amount", f"""WITH {RECORDS_SQL} SELECT row_id, amount_value FROM records ORDER BY amount_value DESC, row_id LIMIT 100""")
def _(spark, d):
    from .search import Query, search

    return search(records(spark, d), Query(), AS_OF).limit(100).select("row_id", "amount_value")


@query("D29_rollup_mix", """SELECT r_name, n_name, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def _(spark, d):
    j = t(spark, d, "customer").join(t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")), F.col("c_nationkey") == F.col("n_nationkey"))
    return reports.mix(j, ["r_name", "n_name"], "c_acctbal")


@query("D30_text_verdict", """SELECT doc_id, CASE WHEN n_chars / greatest(CAST(doc_id % 60 AS INTEGER), 1) < 50 THEN 'scanned' ELSE 'text' END AS verdict FROM documents""")
def _(spark, d):
    return t(spark, d, "documents").select("doc_id", P.text_verdict(F.col("n_chars"), (F.col("doc_id") % 60).cast("int")).alias("verdict"))


@query("D31_parser_chain", r"""SELECT doc_id, CASE WHEN regexp_extract(text, '([a-z]+!!)', 1) <> '' THEN 'loud' WHEN regexp_extract(text, '([A-Za-z]+\|)', 1) <> '' THEN 'table' WHEN regexp_extract(text, '(?:^|\n)([A-Z][a-z]+ [a-z]+)', 1) <> '' THEN 'lead' END AS source,
  coalesce(nullif(regexp_extract(text, '([a-z]+!!)', 1), ''), nullif(regexp_extract(text, '([A-Za-z]+\|)', 1), ''), nullif(regexp_extract(text, '(?:^|\n)([A-Z][a-z]+ [a-z]+)', 1), '')) AS description FROM documents""")
def _(spark, d):
    pattern = lambda p: lambda c: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    chain = [("loud", pattern("([a-z]+!!)")), ("table", pattern(r"([A-Za-z]+\|)")), ("lead", pattern(r"(?:^|\n)([A-Z][a-z]+ [a-z]+)"))]
    return described(t(spark, d, "documents").select("doc_id", "text"), "text", chain).select("doc_id", "source", "description")


@query("D32_html_links", r"""WITH l AS (SELECT page_id, regexp_extract_all(html, '(?is)<a[^>]*\bhref=["''][^"'']*/([^"''&]+)[^"'']*["''][^>]*>(.*?)</a>', 1) AS links FROM pages) SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS position, links[i] AS token FROM (SELECT page_id, links, unnest(range(1, len(links) + 1)) AS i FROM l) WHERE list_position(links, links[i]) = i""")
def _(spark, d):
    links = html.file_links(t(spark, d, "pages").select("page_id", "html"), pattern="/([^\"'&]+)")
    return links.select("page_id", "position", "token")


@query("D33_url_params", r"""SELECT page_id, coalesce(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, coalesce(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref FROM pages""")
def _(spark, d):
    return t(spark, d, "pages").select("page_id", N.query_param(F.col("url"), "page").alias("page"), N.query_param(F.col("url"), "ref").alias("ref"))


@query("D34_late_catchup", """WITH m AS (SELECT max(CAST(ts AS DATE)) AS as_of FROM events) SELECT event_id FROM events e, m WHERE CAST(ts AS DATE) >= as_of - 35 AND NOT EXISTS (SELECT 1 FROM events h WHERE h.user_id = e.user_id AND h.event_type = 'purchase' AND h.value > 60)""")
def _(spark, d):
    e = t(spark, d, "events").withColumn("day", F.to_date("ts"))
    as_of = e.agg(F.max("day")).first()[0]
    return guards.late(e, e.where("event_type = 'purchase' and value > 60"), "user_id", "day", F.lit(as_of)).select("event_id")


@query("D35_set_ops", """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F')
SELECT 'union' AS op, count(*) AS n FROM (SELECT k FROM a UNION SELECT k FROM b) UNION ALL SELECT 'intersect', count(*) FROM (SELECT k FROM a INTERSECT SELECT k FROM b) UNION ALL SELECT 'except', count(*) FROM (SELECT k FROM a EXCEPT SELECT k FROM b)""")
def _(spark, d):
    o = t(spark, d, "orders")
    return diff.set_sizes(o.where("o_orderstatus = 'O'"), o.where("o_orderstatus = 'F'"), "o_custkey")


@query("D36_vendor_match", """WITH n AS (SELECT DISTINCT p_name, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part) SELECT p_name, (a LIKE 'widge%' AND b LIKE 'sma%') OR (b LIKE 'widge%' AND a LIKE 'sma%') AS swapped, contains(p_name, 'l wid') AS inside, a || b LIKE 'hotrin%' AS together FROM n""")
def _(spark, d):
    names, name = t(spark, d, "part").select("p_name").distinct(), F.col("p_name")
    return names.select("p_name", S.vendor_matches(name, "widge sma").alias("swapped"), S.vendor_matches(name, "l wid").alias("inside"), S.vendor_matches(name, "ho-t rin").alias("together"))


@query("F23_agency_match", """SELECT n_name FROM nation WHERE (contains(replace(lower(n_name), '_', ' '), 'tion') AND contains(replace(lower(n_name), '_', ' '), '1')) OR n_name IN ('NATION_7')""")
def _(spark, d):
    n = t(spark, d, "nation").select("n_name")
    return n.where(S.agency_matches(F.col("n_name"), " Tion & 1".replace("&", ""), {"tion 1": ["NATION_7"]}))


@query("D37_dup_lines", """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents) SELECT doc_id, CAST(i - 1 AS INTEGER) AS position, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM l) WHERE list_position(ls, ls[i]) = i""")
def _(spark, d):
    rows = t(spark, d, "documents").select("doc_id", F.split("text", "\n").alias("ls"))
    return fold.first_of_list(rows, "doc_id", "ls", "line")


@query("D38_json_field", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def _(spark, d):
    return t(spark, d, "events").select("event_id", N.json_field(F.col("props"), "k long", "k").alias("k"))


@query("D39_conv_last_turn", """SELECT conv_id, role, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC, text DESC) AS k FROM conversations) WHERE k = 1""")
def _(spark, d):
    c = t(spark, d, "conversations").withColumn("seq", F.struct("turn", "text"))
    return fold.latest(c, ["conv_id", "role"], "seq").select("conv_id", "role", "turn", "text")


@query("D40_release_regress", """SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels""")
def _(spark, d):
    return diff.lost(t(spark, d, "documents"), t(spark, d, "labels"), "doc_id")


@query("U05_release_report", """WITH o AS (SELECT doc_id AS tok FROM documents), n AS (SELECT doc_id AS tok FROM labels) SELECT * FROM (SELECT 'tokens lost' AS reason, count(*) AS n FROM (SELECT tok FROM o EXCEPT SELECT tok FROM n) UNION ALL SELECT 'texts lost', count(*) FROM (SELECT tok FROM o EXCEPT SELECT tok FROM n) UNION ALL SELECT 'fewer records', (SELECT count(*) FROM o) - (SELECT count(*) FROM n)) WHERE n > 0""")
def _(spark, d):
    old = t(spark, d, "documents").select(F.col("doc_id").alias("tok"), "text")
    return reports.regression(old, t(spark, d, "labels").select(F.col("doc_id").alias("tok"), F.lit("x").alias("text")))


@query("A04_spend_by_group", """WITH g AS (SELECT c_name, CASE WHEN c_custkey % 10 = 0 THEN 'GROUP ' || (c_custkey % 100) ELSE c_name END AS vendor_group FROM customer) SELECT vendor_group, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n FROM orders JOIN customer c ON o_custkey = c_custkey JOIN g ON g.c_name = c.c_name GROUP BY 1""")
def _(spark, d):
    c = t(spark, d, "customer")
    groups = c.where("c_custkey % 10 = 0").select(F.concat(F.lit("GROUP "), (F.col("c_custkey") % 100).cast("string")).alias("canonical"), F.col("c_name").alias("spelling"))
    rows = t(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_name").alias("vendor"), F.col("o_totalprice").alias("amount_value"))
    return vendors.spend(vendors.grouped(rows, groups), "vendor_group").withColumnRenamed("vendor", "vendor_group")


@query("A05_dropped", """WITH r AS (SELECT o_orderkey AS seq, o_custkey AS u, o_orderpriority AS p, CASE WHEN o_orderstatus = 'F' THEN 'Expired' ELSE 'Active' END AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS a FROM orders),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY u, p, status ORDER BY seq) AS k FROM r) WHERE k = 1),
two AS (SELECT * FROM one x WHERE status <> 'Expired' OR NOT EXISTS (SELECT 1 FROM one y WHERE y.status = 'Active' AND y.u = x.u AND y.p = x.p)),
three AS (SELECT * FROM two x WHERE status <> 'Expired' OR NOT EXISTS (SELECT 1 FROM two y WHERE y.status = 'Active' AND y.u = x.u)),
n AS (SELECT 'r' AS t, count(*) AS n, CAST(sum(a) AS DOUBLE) AS s FROM r UNION ALL SELECT 'one', count(*), CAST(sum(a) AS DOUBLE) FROM one UNION ALL SELECT 'two', count(*), CAST(sum(a) AS DOUBLE) FROM two UNION ALL SELECT 'three', count(*), CAST(sum(a) AS DOUBLE) FROM three)
SELECT reason, CAST(x.n - y.n AS BIGINT) AS rows, round(x.s - y.s, 2) AS dollars FROM (VALUES ('exact', 'r', 'one'), ('twin', 'one', 'two'), ('stale', 'two', 'three')) v(reason, a, b) JOIN n x ON x.t = a JOIN n y ON y.t = b""")
def _(spark, d):
    blank = {c: F.lit("") for c in RECORD.names}
    own = {"doc_number": F.lit("A"), "entity_name": F.col("o_orderpriority"), "detail_url": F.col("o_custkey").cast("string"), "status": F.when(F.col("o_orderstatus") == "F", "Expired").otherwise("Active")}
    rows = t(spark, d, "orders").select(*[(blank | own)[c].alias(c) for c in RECORD.names], F.col("o_orderkey").alias("seq"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount_value"))
    return dedup.dropped(rows).select("reason", F.col("rows").cast("long").alias("rows"), F.round(F.col("dollars").cast("double"), 2).alias("dollars"))


@query("A09_coverage", """SELECT lang AS dataset, count(*) AS total, count(quality) AS checked, count(*) FILTER (quality * 2 > 1) AS multi, coalesce(CAST(sum(quality * 2) AS BIGINT), 0) AS documents FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def _(spark, d):
    rows = t(spark, d, "documents").select(F.col("doc_id").alias("k"), F.col("lang").alias("dataset"))
    return documents.coverage(rows, t(spark, d, "labels").select(F.col("doc_id").alias("k"), (F.col("quality") * 2).alias("n")))


@query("A10_scan_totals", """SELECT count(*) AS records, count(DISTINCT conv_id) AS tokens, count(DISTINCT conv_id) FILTER (trim(text) <> '') AS tokens_with_text FROM conversations""")
def _(spark, d):
    return reports.scan_totals(t(spark, d, "conversations").select(F.col("conv_id").alias("tok"), "text"))


@query("A11_diff_totals", """WITH f AS (SELECT event_type, CAST(ts AS DATE) AS night, user_id, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE), user_id ORDER BY event_id) AS k FROM events) WHERE k = 1) SELECT event_type AS dataset, night, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM f GROUP BY 1, 2""")
def _(spark, d):
    e = t(spark, d, "events").select(F.col("event_type").alias("dataset"), F.to_date("ts").alias("night"), F.col("user_id").alias("entity"), F.col("event_id").alias("seq"), F.col("value").cast("decimal(18,2)").alias("value"))
    return reports.diff_totals(e, ["value"]).withColumn("value", F.col("value").cast("double"))


@query("A12_freshness", """SELECT min(m) AS at FROM (SELECT event_type, max(ts) AS m FROM events GROUP BY 1)""")
def _(spark, d):
    stamps = t(spark, d, "events").groupBy(F.col("event_type").alias("dataset")).agg(F.max("ts").alias("at"))
    return guards.freshness(stamps, stamps.count())


@query("A13_alphabet", """SELECT string_agg(c, '' ORDER BY c) AS alphabet FROM (SELECT DISTINCT unnest(string_split(p_name, '')) AS c FROM part) WHERE c <> ''""")
def _(spark, d):
    return reports.alphabet(t(spark, d, "part"), "p_name")


@query("A14_combinations", """SELECT DISTINCT l_returnflag, l_linestatus, CAST(dense_rank() OVER (ORDER BY l_returnflag, l_linestatus) - 1 AS BIGINT) AS idx FROM lineitem""")
def _(spark, d):
    pairs = t(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.lit(0).alias("z")).drop("z")
    return fold.first_seen_index(pairs.select(F.struct("l_returnflag", "l_linestatus").alias("pair"), F.struct("l_returnflag", "l_linestatus").alias("o")), "pair", "o").select("pair.*", "idx")


@query("A15_one_to_one", """SELECT c_nationkey, count(DISTINCT c_mktsegment) AS values FROM customer GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 1""")
def _(spark, d):
    return reports.one_to_one(t(spark, d, "customer"), "c_nationkey", "c_mktsegment")


@query("A17_ambiguous", """SELECT user_id, count(*) FILTER (event_type = 'view') AS blank FROM events GROUP BY 1 HAVING count(*) FILTER (event_type = 'view') > 1""")
def _(spark, d):
    e = t(spark, d, "events").withColumn("view_url", F.when(F.col("event_type") == "view", "").otherwise("x"))
    return dedup.ambiguous(e, ["user_id"], "view_url")


def _checksum_sql(column: str) -> str:
    h = f"md5(coalesce('=' || CAST({column} AS VARCHAR), 'null'))"
    return f"""SELECT '{column}' AS "column", count(*) AS rows, CAST(sum(('0x' || left({h}, 15))::BIGINT) AS VARCHAR) AS sum, bit_xor(('0x' || substring({h}, 17, 15))::BIGINT) AS xor FROM orders"""


@query("A19_checksum", " UNION ALL ".join(map(_checksum_sql, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])))
def _(spark, d):
    from ..sources.snapshots import checksum

    return checksum(t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))


@query("A20_median_latency", """SELECT median(value) AS median FROM events WHERE ts > TIMESTAMP '2024-01-15'""")
def _(spark, d):
    return reports.median_since(t(spark, d, "events"), "value", "ts", F.lit("2024-01-15").cast("timestamp_ntz"))


@query("J08_described", """WITH p AS (SELECT page_id AS row_id, page_id % 50 AS tok, page_id % 3 AS position FROM pages), s AS (SELECT doc_id AS seq, doc_id % 50 AS tok, text AS description FROM documents)
SELECT row_id, description FROM (SELECT row_id, description, row_number() OVER (PARTITION BY row_id ORDER BY CASE WHEN position = 0 THEN 0 ELSE 1 + position END, seq DESC) AS k FROM p JOIN s USING (tok)) WHERE k = 1""")
def _(spark, d):
    places = t(spark, d, "pages").select((F.col("page_id") % 50).alias("token"), F.col("page_id").alias("row_id"), (F.col("page_id") % 3).cast("int").alias("position")).withColumn("is_primary", F.col("position") == 0)
    # Of a token's lines only the last can win, so the log is folded before it is joined: no token is multiplied.
    scope = fold.latest(t(spark, d, "documents").select((F.col("doc_id") % 50).alias("tok"), F.col("doc_id").alias("seq"), F.col("text").alias("description"), F.lit("line_items").alias("source")), ["tok"], "seq")
    return documents.described(places, scope).select("row_id", "description")


@query("J11_ST17_carry_forward", """SELECT doc_id, lang FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, 'carried' FROM documents WHERE lang <> 'en' AND doc_id IN (SELECT doc_id FROM labels)""")
def _(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "lang")
    prior = documents.carried_forward(docs.withColumn("lang", F.lit("carried")), t(spark, d, "labels"), "doc_id")
    return documents.with_floor(docs.where("lang = 'en'"), prior, ["doc_id"])


@query("J17_to_do", """SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def _(spark, d):
    return documents.to_do(t(spark, d, "documents").select("doc_id"), t(spark, d, "labels"), "doc_id", F.col("quality") == 0)


@query("J12_stale_spellings", """SELECT s_name AS spelling, 'x' AS canonical FROM supplier WHERE s_name NOT IN (SELECT c_name FROM customer)""")
def _(spark, d):
    groups = t(spark, d, "supplier").select(F.col("s_name").alias("spelling"), F.lit("x").alias("canonical"))
    return vendors.stale_spellings(t(spark, d, "customer").select(F.col("c_name").alias("vendor")), groups)


@query("J06_expired_only", """SELECT DISTINCT o_custkey AS url FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'F')""")
def _(spark, d):
    rows = t(spark, d, "orders").select(F.col("o_custkey").alias("url"), F.when(F.col("o_orderstatus") == "F", "Expired").otherwise("Active").alias("status"))
    return diff.expired_only(rows, "url")


@query("P19_O4_sample_per_source", """SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5('0:' || doc_id), doc_id) AS k FROM documents) WHERE k <= 5""")
def _(spark, d):
    return reports.sample_per_group(t(spark, d, "documents").select("source", "doc_id"), "source", "doc_id", 5)


@query("P07_E4_quarantine", f"""WITH {RECORDS_SQL}, r AS (SELECT row_id, entity_name, CASE WHEN row_id % 13 = 0 THEN '' ELSE 'u' || row_id END AS u, CASE WHEN row_id % 17 = 0 THEN 'a' || row_id WHEN row_id % 19 = 0 THEN '' WHEN row_id % 23 = 0 THEN repeat('Ä', 128) ELSE 'A' || row_id END AS n FROM records)
SELECT * FROM (SELECT row_id, CASE WHEN entity_name = 'NATION_3' THEN 'unknown entity' WHEN u = '' THEN 'no detail URL' WHEN n = '' THEN 'no document number' WHEN octet_length(encode(n)) > 255 THEN 'long document number' WHEN n <> upper(n) THEN 'lower-case document number' END AS reason FROM r) WHERE reason IS NOT NULL""")
def _(spark, d):
    k = F.col("row_id")
    number = F.when(k % 17 == 0, F.concat(F.lit("a"), k.cast("string"))).when(k % 19 == 0, "").when(k % 23 == 0, "Ä" * 128).otherwise(F.concat(F.lit("A"), k.cast("string")))
    rows = records(spark, d).withColumn("doc_number", number).withColumn("detail_url", F.when(k % 13 == 0, "").otherwise(F.concat(F.lit("u"), k.cast("string"))))
    known = [r.n_name for r in t(spark, d, "nation").where("n_name <> 'NATION_3'").collect()]
    return guards.quarantined(rows, guards.record_rules(known)).select("row_id", "reason")


@query("F28_verbatim", """WITH n AS (SELECT a.doc_id, a.text, list_filter(regexp_split_to_array(b.text, '[ \t\n\r\f]+'), lambda x: x <> '')[1:3] AS words FROM documents a JOIN documents b ON b.doc_id = a.doc_id // 2)
SELECT doc_id, regexp_matches(text, '(?s)' || array_to_string(list_transform(words, lambda x: regexp_escape(x)), '.*')) AS verbatim FROM n""")
def _(spark, d):
    docs = t(spark, d, "documents")
    other = docs.select(F.col("doc_id").alias("b"), F.array_join(F.slice(F.filter(F.split("text", "[ \t\n\r\f]+"), lambda w: w != ""), 1, 3), " ").alias("words"))
    rows = docs.withColumn("b", F.floor(F.col("doc_id") / 2)).join(other, "b")
    return rows.select("doc_id", S.is_verbatim(F.col("words"), F.col("text")).alias("verbatim"))


@query("K10_csv_guard", """SELECT page_id, CASE WHEN regexp_matches(left(html, 1), '^[=+\\-@\\t\\r]') THEN '''' || html ELSE html END AS cell, CASE WHEN page_id % 3 = 0 THEN '''-' || url ELSE url END AS formula FROM pages""")
def _(spark, d):
    return t(spark, d, "pages").select("page_id", N.csv_guard(F.col("html")).alias("cell"), N.csv_guard(F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("-"), "url")).otherwise(F.col("url"))).alias("formula"))


@query("ST14_suspicious", """WITH r AS (SELECT event_type AS dataset, user_id AS entity, count(*) AS previously_active, count(*) FILTER (value > 40) AS flipped FROM events GROUP BY 1, 2) SELECT * FROM r WHERE previously_active >= 5 AND flipped * 2 > previously_active""")
def _(spark, d):
    r = t(spark, d, "events").groupBy(F.col("event_type").alias("dataset"), F.col("user_id").alias("entity")).agg(F.count("*").alias("previously_active"), F.count_if(F.col("value") > 40).alias("flipped"))
    return guards.suspicious(r)


@query("ST02_patch", """WITH f AS (SELECT o_custkey FROM customer, (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 7 = 0) WHERE c_custkey = o_custkey)
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' AND o_custkey % 7 = 0 THEN 'Expired' WHEN o_orderstatus = 'F' AND o_custkey % 7 = 1 AND o_orderkey = max(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) OVER (PARTITION BY o_custkey) THEN 'Active' WHEN o_orderstatus = 'F' THEN 'Expired' ELSE 'Active' END AS status,
  CASE WHEN o_custkey % 7 = 2 AND o_orderstatus <> 'F' THEN 'AMENDED' ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def _(spark, d):
    rows = t(spark, d, "orders").select(F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("detail_url"), F.when(F.col("o_orderstatus") == "F", "Expired").otherwise("Active").alias("status"), "o_orderpriority", "o_orderkey")
    urls = rows.select("detail_url").distinct()
    amended = urls.where("detail_url % 7 = 2").select("detail_url", F.lit("o_orderpriority").alias("field"), F.lit("AMENDED").alias("to"))
    return diff.patched(rows, urls.where("detail_url % 7 = 0"), urls.where("detail_url % 7 = 1"), amended).select("o_orderkey", "status", "o_orderpriority")
