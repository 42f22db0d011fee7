"""Queries on the nightly difference, its guards and its ledgers, and on reports.

A snapshot of records is made of the orders: a customer's nation is the entity, an order's key its URL. Tonight's listing
lacks some of them, has some new ones, and some with another amount.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import diff, fold, guards, reports, vendors
from ..sources import scratch, snapshots
from ..sources.schemas import RECORD
from . import nightly
from .catalogue import query, t


def rows_of(orders: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    blank = {c: F.lit("") for c in RECORD.names}
    return orders.select(*[(blank | kinds)[c].alias(c) for c in RECORD.names], F.left("o_orderpriority", F.lit(1)).alias("dataset"), "seq")


def judged(spark: SparkSession, d: str) -> nightly.Night:
    known, seen, ledger = night_tables(spark, d)
    return nightly.judged(known, seen, ledger, known.unionByName(seen))


def night_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Known records, tonight's rows and the flip ledger."""
    o = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    key, nation = F.col("o_orderkey"), F.col("c_nationkey")
    entity = F.concat(F.lit("E"), nation.cast("string"))
    own = {"doc_number": key.cast("string"), "entity_name": entity, "vendor": F.col("c_name"), "amount": F.format_string("$%.2f", "o_totalprice"), "detail_url": F.concat(F.lit("u"), key.cast("string"))}
    known = o.where("o_orderkey % 10 <> 9").withColumn("seq", key * 2)
    base = rows_of(known, own | {"status": F.when(key % 10 == 8, "Expired").otherwise("Active")})
    # Some Active rows have an Expired twin of the same URL with another amount.
    twins = rows_of(known.where("o_orderkey % 10 = 1").withColumn("seq", key * 2 - 1), own | {"status": F.lit("Expired"), "amount": F.lit("$0.01")})
    listed = (key % 10 == 9) | ((key % 10 == 8) & (key % 4 == 0)) | ((key % 10 < 8) & ~((nation < 3) & (key % 10 < 6)) & ~((nation >= 3) & (key % 10 == 0)))
    seen = rows_of(o.where(listed).withColumn("seq", key + 10_000_000), own | {"status": F.lit("Active"), "amount": F.when(key % 20 == 1, "$7.00").otherwise(own["amount"])})
    ledger = o.where("o_orderkey % 8 = 0").select(own["detail_url"].alias("detail_url"))
    return base.unionByName(twins), seen, ledger


NIGHT_SQL = """WITH o AS (SELECT o_orderkey AS k, c_nationkey AS n, left(o_orderpriority, 1) AS ds, printf('$%.2f', o_totalprice) AS amount FROM orders JOIN customer ON o_custkey = c_custkey),
m AS (SELECT *, k % 10 <> 9 AND k % 10 <> 8 AS active, k % 10 = 8 AS expired, k % 10 = 9 OR (k % 10 = 8 AND k % 4 = 0) OR (k % 10 < 8 AND NOT (n < 3 AND k % 10 < 6) AND NOT (n >= 3 AND k % 10 = 0)) AS listed FROM o),
kinds AS (SELECT *, CASE WHEN active AND listed THEN 'kept' WHEN active THEN 'vanished' WHEN expired AND listed AND k % 8 = 0 THEN 'restored' WHEN expired AND listed THEN 'stray' WHEN listed THEN 'new' END AS kind FROM m),
per AS (SELECT ds, n, count(*) FILTER (active) AS known, count(*) FILTER (kind = 'vanished') AS vanished, count(*) FILTER (listed) AS listed, count(*) FILTER (kind = 'stray') AS strays FROM kinds GROUP BY 1, 2),
v AS (SELECT *, (known >= 5 AND listed = 0) OR (known >= 20 AND vanished * 2 > known) AS refused, (strays >= 5 AND strays * 20 > listed) OR (sum(strays) OVER w >= 5 AND sum(strays) OVER w * 20 > sum(listed) OVER w) AS leaky, sum(known) OVER w >= 50 AND sum(vanished) OVER w * 2 > sum(known) OVER w AS broken FROM per WINDOW w AS (PARTITION BY ds)),
j AS (SELECT kinds.*, refused, leaky, broken FROM kinds JOIN v USING (ds, n))"""


@query("ST1_ST2_ST9_X10_X12_next_snapshot", NIGHT_SQL + """ SELECT 'u' || k AS detail_url, CASE WHEN expired THEN CASE WHEN kind = 'restored' AND NOT leaky AND NOT broken THEN 'Active' ELSE 'Expired' END WHEN active THEN CASE WHEN kind = 'vanished' AND NOT refused AND NOT broken THEN 'Expired' ELSE 'Active' END ELSE 'Active' END AS status,
  CASE WHEN kind = 'kept' AND NOT broken AND k % 20 = 1 THEN '$7.00' WHEN kind = 'new' AND k % 20 = 1 THEN '$7.00' ELSE amount END AS amount FROM j WHERE active OR expired OR (kind = 'new' AND NOT leaky)
UNION ALL SELECT 'u' || k, 'Expired', '$0.01' FROM j WHERE k % 10 = 1""")
def _(spark, d):
    known, seen, ledger = night_tables(spark, d)
    return nightly.next_snapshot(known, nightly.judged(known, seen, ledger, known.unionByName(seen))).select("detail_url", "status", "amount")


@query("ST8_W16_night_report", NIGHT_SQL + """ SELECT ds AS dataset, 'E' || n AS entity_name, count(*) FILTER (active) AS previously_active, count(*) FILTER (kind = 'kept') AS still_active, count(*) FILTER (kind = 'new') AS newly_active, count(*) FILTER (kind = 'restored') AS flipped_back,
  count(*) FILTER (kind = 'vanished' AND NOT refused AND NOT broken) AS flipped_to_expired, count(*) FILTER (kind = 'new' AND leaky) AS held_back FROM j GROUP BY 1, 2""")
def _(spark, d):
    return judged(spark, d).report


@query("ST8_held_rows", NIGHT_SQL + " SELECT 'u' || k AS detail_url, CASE WHEN leaky THEN 'held' ELSE 'new' END AS state FROM j WHERE kind = 'new'")
def _(spark, d):
    night = judged(spark, d)
    return night.new_rows.select("detail_url", F.lit("new").alias("state")).unionByName(night.held_back.select("detail_url", F.lit("held").alias("state")))


@query("ST9_change_log", NIGHT_SQL + " SELECT 'u' || k AS detail_url, 'amount' AS field, amount AS \"from\", '$7.00' AS \"to\" FROM j WHERE kind = 'kept' AND NOT broken AND k % 20 = 1 AND amount <> '$7.00'")
def _(spark, d):
    # The log is appended to, and read back as it stands.
    path = scratch.folder(spark, "changes")
    snapshots.append_json(judged(spark, d).changes, path)
    return spark.read.schema("detail_url string, field string, `from` string, `to` string").json(path)


@query("ST3_live_ledger", "SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'unreadable' ELSE CAST(CAST(ts AS DATE) - CAST(event_id % 500 AS INTEGER) AS VARCHAR) END AS seen FROM events WHERE event_id % 50 = 0 OR date_diff('day', CAST(ts AS DATE) - CAST(event_id % 500 AS INTEGER), DATE '2024-02-01') <= 365")
def _(spark, d):
    day = F.date_sub(F.to_date("ts"), (F.col("event_id") % 500).cast("int")).cast("string")
    ledger = t(spark, d, "events").select("event_id", F.when(F.col("event_id") % 50 == 0, "unreadable").otherwise(day).alias("seen"))
    return guards.live_ledger(ledger, F.lit("2024-02-01").cast("date"))


@query("W13_persistent_leaks", """WITH n AS (SELECT user_id, CAST(ts AS DATE) AS night, bool_or(event_type IN ('error', 'view')) AS leaked FROM events GROUP BY 1, 2), c AS (SELECT user_id, max(night) AS clean FROM n WHERE NOT leaked GROUP BY 1)
SELECT n.user_id, count(*) AS nights, max(night) AS last FROM n LEFT JOIN c USING (user_id) WHERE leaked AND (clean IS NULL OR night > clean) GROUP BY 1 HAVING count(*) >= 3""")
def _(spark, d):
    e = t(spark, d, "events").select("user_id", F.to_date("ts").alias("night"), F.col("event_type").isin("error", "view").alias("leaked"))
    return guards.persistent(guards.streaks(e, "user_id"))


@query("W14_failure_run", """WITH m AS (SELECT event_type, event_id, value > 5 AS bad, sum(CASE WHEN value > 5 THEN 0 ELSE 1 END) OVER (PARTITION BY event_type ORDER BY event_id) AS run FROM events) SELECT event_type, min(event_id) AS run_start, max(event_id) AS run_end, count(*) AS length FROM m WHERE bad GROUP BY event_type, run HAVING count(*) >= 25""")
def _(spark, d):
    return fold.islands(t(spark, d, "events"), ["event_type"], ["event_id"], F.col("value") > 5).where(F.col("length") >= guards.FAILURE_RUN)


@query("ST10_swept_pages", """WITH p AS (SELECT user_id AS entity, (row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) - 1) // 5 AS page, CAST(ts AS DATE) AS begin, event_id FROM events), n AS (SELECT entity, page, max(begin) AS newest FROM p GROUP BY 1, 2), s AS (SELECT entity, min(page) AS stop FROM n WHERE newest < DATE '2024-02-20' - 35 GROUP BY 1)
SELECT p.entity, p.page, event_id FROM p LEFT JOIN s USING (entity) WHERE stop IS NULL OR p.page < stop""")
def _(spark, d):
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("ts"), "event_id")) - 1
    listed = t(spark, d, "events").select(F.col("user_id").alias("entity"), F.floor(place / 5).cast("long").alias("page"), F.to_date("ts").alias("begin"), "event_id")
    return guards.whole_pages(listed, F.lit("2024-02-20").cast("date")).select("entity", "page", "event_id")


@query("ST13_accounted_rows", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 40 = 3)")
def _(spark, d):
    docs = t(spark, d, "documents").select("doc_id")
    # A fixed share is dropped here, so it grows with the table; the guard's refusal is one of the query on refusals.
    return guards.unfinished(docs, docs.where("doc_id % 40 <> 3"), "doc_id", limit=None)


@query("ST14_X18_judged_report", "SELECT true AS failed, 0 AS left FROM (SELECT 1) WHERE EXISTS (SELECT 1 FROM events GROUP BY event_type HAVING count(*) >= 5 AND count(*) FILTER (value > 1) * 2 > count(*))")
def _(spark, d):
    path = scratch.folder(spark, "report")
    made = t(spark, d, "events").groupBy(F.col("event_type").alias("entity"), F.lit("d").alias("dataset")).agg(F.count("*").alias("previously_active"), F.count_if(F.col("value") > 1).alias("flipped"))
    made.write.parquet(path)
    kept = spark.read.parquet(path)
    schema = kept.schema
    found = guards.judged_and_cleared(kept, lambda empty: spark.createDataFrame([], schema).write.mode("overwrite").parquet(path), lambda r: not guards.suspicious(r).isEmpty())
    left = spark.read.schema(schema).parquet(path).count()
    return spark.createDataFrame([(found, left)], "failed boolean, left int")


@query("ST15_X14_stale_stamps", """WITH s AS (SELECT event_type AS dataset, CASE WHEN event_type = 'error' THEN NULL ELSE max(ts) END AS stamp FROM events WHERE event_type <> 'view' OR ts < TIMESTAMP '2024-01-15' GROUP BY 1) SELECT dataset, CASE WHEN stamp IS NULL THEN 'unreadable' ELSE 'stale' END AS reason FROM s WHERE stamp IS NULL OR stamp < TIMESTAMP '2024-01-25'""")
def _(spark, d):
    from ..functions.normalize import strict_timestamp

    e = t(spark, d, "events").where("event_type <> 'view' or ts < timestamp'2024-01-15'").groupBy(F.col("event_type").alias("dataset")).agg(F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("s"))
    # A stamp without an offset, or none at all, isn't read; it never fails the reader.
    text = F.when(F.col("dataset") == "error", F.col("s")).otherwise(F.concat("s", F.lit("Z")))
    stamps = e.select("dataset", strict_timestamp(text).alias("at"))
    return guards.stale_stamps(stamps, F.lit("2024-01-25T00:00:00Z").cast("timestamp")).select("dataset", "reason")


@query("ST16_deployed", "SELECT event_id, event_id % 5 >= 3 AS live FROM events")
def _(spark, d):
    at = F.col("ts")
    built = at - F.make_interval(mins=F.lit(5)) + F.make_interval(mins=(F.col("event_id") % 5).cast("int"))
    return t(spark, d, "events").select("event_id", guards.deployed(built, at).alias("live"))


@query("ST18_service_canary", "SELECT user_id, NOT (count(*) FILTER (event_type <> 'error') > 0 AND count(*) FILTER (event_type <> 'error' AND value > 25) = 0) AS healthy FROM events WHERE user_id < 20 AND event_id % 40 = 0 GROUP BY 1")
def _(spark, d):
    e = t(spark, d, "events").where("user_id < 20 and event_id % 40 = 0").select("user_id", (F.col("event_type") != "error").alias("clean"), F.when(F.col("value") > 25, 1).otherwise(0).alias("files"))
    each = [guards.service_healthy(e.where(f"user_id = {k}")).select(F.lit(k).cast("long").alias("user_id"), "healthy") for k in range(20)]
    out = each[0]
    for x in each[1:]:
        out = out.unionByName(x)
    return out.join(e.select("user_id").distinct(), "user_id", "left_semi")


@query("ST19_J13_guarded_drift", """WITH a AS (SELECT n_name AS key, n_regionkey AS value FROM nation), b AS (SELECT n_name AS key, n_regionkey AS value FROM nation WHERE n_nationkey >= 10 UNION ALL SELECT 'NEW', 1)
SELECT 'half' AS listing, true AS failed, NULL AS key, NULL AS change UNION ALL SELECT 'most', false, coalesce(a.key, b.key), CASE WHEN a.key IS NULL THEN 'added' ELSE 'removed' END FROM a FULL JOIN b ON a.key = b.key WHERE a.key IS NULL OR b.key IS NULL""")
def _(spark, d):
    n = t(spark, d, "nation").select(F.col("n_name").alias("key"), F.col("n_regionkey").alias("value"), "n_nationkey")
    old, more = n.drop("n_nationkey"), spark.createDataFrame([("NEW", 1)], "key string, value int")
    out = None
    for name, listing in (("half", n.where("n_nationkey >= 14").drop("n_nationkey")), ("most", n.where("n_nationkey >= 10").drop("n_nationkey").unionByName(more))):
        # A listing that lost more than half is a failed read, not a drift of its entries.
        failed = diff.implausible(old, listing)
        rows = spark.createDataFrame([(None, None)], "key string, change string") if failed else diff.mapping_drift(old, listing).select("key", "change")
        rows = rows.select(F.lit(name).alias("listing"), F.lit(failed).alias("failed"), "key", "change")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("O5_work_list", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 2000")
def _(spark, d):
    work = t(spark, d, "lineitem").withColumn("seq", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    return guards.work_list(work).select("l_orderkey", "l_linenumber", "l_partkey")


@query("O6_stray_sample", "SELECT lang || source AS entity, list_sort(list(DISTINCT CAST(doc_id AS VARCHAR)))[1:5] AS sample, count(DISTINCT doc_id) AS strays FROM documents GROUP BY 1")
def _(spark, d):
    return guards.stray_sample(t(spark, d, "documents").select(F.concat("lang", "source").alias("entity"), F.col("doc_id").cast("string").alias("id")))


@query("K9_P20_drawn_sample", "SELECT o_orderkey FROM orders ORDER BY md5('7:' || o_orderkey), o_orderkey LIMIT 100")
def _(spark, d):
    return reports.sample(t(spark, d, "orders").select("o_orderkey"), "o_orderkey", 100, 7)


@query("U6_entities", "SELECT name, row_number() OVER (ORDER BY name) - 1 AS place FROM (SELECT n_name AS name FROM nation UNION SELECT r_name FROM region UNION SELECT 'NATION_1')")
def _(spark, d):
    n, r = t(spark, d, "nation").select(F.col("n_name").alias("name")), t(spark, d, "region").select(F.col("r_name").alias("name"))
    return fold.numbered(diff.union_of([n, r, n.where("name = 'NATION_1'")], "name"), ["name"], "place").select("name", "place")


@query("X4_J12_vendor_groups", "SELECT o_orderkey, CASE WHEN c_custkey % 10 = 0 THEN 'GROUP ' || (c_custkey % 100) ELSE c_name END AS vendor_group FROM orders JOIN customer ON o_custkey = c_custkey")
def _(spark, d):
    c = t(spark, d, "customer")
    groups = c.where("c_custkey % 10 = 0").select(F.concat(F.lit("GROUP "), (F.col("c_custkey") % 100).cast("string")).alias("canonical"), F.col("c_name").alias("spelling"))
    rows = t(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_name").alias("vendor"))
    path = scratch.folder(spark, "groups")
    vendors.grouped(rows, groups).write.parquet(path)
    return spark.read.parquet(path).select("o_orderkey", "vendor_group")


@query("A22_asset_age", "SELECT event_id, date_diff('day', CAST(ts AS DATE), DATE '2024-02-05') AS age_days, date_diff('day', CAST(ts AS DATE), DATE '2024-02-05') > 14 AS warn FROM events")
def _(spark, d):
    age = reports.age_days(F.to_date("ts"), F.lit("2024-02-05").cast("date"), 14)
    return t(spark, d, "events").select("event_id", age["age_days"].cast("long").alias("age_days"), age["warn"].alias("warn"))
