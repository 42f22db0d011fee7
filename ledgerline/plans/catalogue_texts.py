"""Queries on texts: the parsers of document forms, matching, search, packing, summaries.

The forms are built from the part table, so every parser meets texts that it accepts and some that it must not.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions import predicates as P
from ..functions import search as S
from ..functions.parsers import described
from ..operators import documents, fold
from . import extraction, nightly, search
from .catalogue import AS_OF, RECORDS_SQL, query, records, t

TEXT_SQL = "WITH x AS (SELECT p_partkey, p_name AS n, lower(p_type) AS t, p_partkey % 4 AS k FROM part) SELECT p_partkey, "


def name() -> Column:
    return F.col("p_name")


def kind() -> Column:
    return F.lower("p_type")


def key() -> Column:
    return F.col("p_partkey")


def case() -> Column:
    return key() % 4


def parsed(spark: SparkSession, d: str, text: Column) -> DataFrame:
    """What the whole chain makes of a text of each part."""
    rows = t(spark, d, "part").select("p_partkey", text.alias("text"))
    return described(rows).select("p_partkey", "source", "description", F.size("items").alias("n_items"))


def say(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


NOTICE = "This item involved a direct purchase which did not result in a contract."


@query("F7_direct_purchase", TEXT_SQL + f"CASE WHEN k <> 1 THEN 'direct_purchase' END AS source, CASE WHEN k <> 1 THEN '{NOTICE} ' || n END AS description, 0 AS n_items FROM x")
def _(spark, d):
    # Only at the document's start, whatever white space is before and in it.
    return parsed(spark, d, F.when(case() == 1, say("They wrote: ", NOTICE, " ", name())).otherwise(say(" \n", NOTICE.replace(" a direct", "\n a  direct"), "\n", name())))


@query("F5_cover_sheet", TEXT_SQL + "CASE WHEN k > 1 THEN 'cover_sheet' END AS source, CASE k WHEN 2 THEN n || ' for ' || t WHEN 3 THEN n END AS description, 0 AS n_items FROM x")
def _(spark, d):
    lead = "Contract Summary (brief description and/\n or event\n name)  "
    summary = F.when(case() == 3, say(lead, name(), "\nStart Date 1/2/2024")).when(case() == 2, say(lead, name(), "\n for ", kind(), "  Purchase Category x Start Date"))
    # Without a label behind it, or without the sheet's title, it is none.
    return parsed(spark, d, F.coalesce(summary, F.when(case() == 1, say("Contract Summary event name) ", name())).otherwise(say("event name) ", name(), " Purchase Category"))))


FORM_HEAD = "CONTRACT COVER SHEET\nUNIVERSITY OF NEBRASKA\nCONTRACT TYPE\nSUPPLIER NAME\nDESCRIPTION OF\nPURCHASE\nDOLLAR AMOUNT\nBUYER NAME\nX\nAcme Co\n"


@query("F6_cover_sheet_form", TEXT_SQL + "CASE WHEN k > 1 THEN 'cover_sheet_form' END AS source, CASE WHEN k > 1 THEN n || ' services' END AS description, 0 AS n_items FROM x")
def _(spark, d):
    # Aligned by an amount or a term; not by neither, and a number is no description.
    proof = F.when(case() == 3, "$4,000.00").when(case() == 2, "ongoing").when(case() == 1, "B. Uyer").otherwise("$4,000.00")
    value = F.when(case() == 0, key().cast("string")).otherwise(say(name(), " services"))
    return parsed(spark, d, say(FORM_HEAD, value, "\n", proof, "\nB. Uyer"))


@query("F9_services_clause", TEXT_SQL + """CASE WHEN k > 0 THEN 'services_clause' END AS source, CASE k WHEN 1 THEN 'The firm shall provide ' || n || ' and ' || t || ' in the hall.' WHEN 2 THEN 'All work on ' || n || ' and other ' || t || ' items. 3. deliveries too'
  WHEN 3 THEN 'The firm shall provide ' || n || ' of the ' || t || ' kind.' END AS description, 0 AS n_items FROM x""")
def _(spark, d):
    one = say("Intro 2. SERVICES The firm shall provide ", name(), " and\n ", kind(), " in the hall. 3. DELIVERY later")
    two = say("SCOPE OF WORK: 2.1 All work on ", name(), " and other ", kind(), " items. 3. deliveries too")
    three = say("7. SCOPE OF SERVICES. The firm shall provide ", name(), " of the ", kind(), " kind. 8.1. PAYMENT in May")
    return parsed(spark, d, F.when(case() == 1, one).when(case() == 2, two).when(case() == 3, three).otherwise(say("2. SERVICES ", name())))


@query("F10_F15_wrapped_items", TEXT_SQL + """CASE WHEN k <> 3 THEN 'line_items' END AS source, CASE k WHEN 0 THEN n || ' in ' || t || '; second ' || n WHEN 1 THEN 'one ' || n || '; two ' || n WHEN 2 THEN left('long ' || n || repeat(' word', 1000), 4000) END AS description,
  CASE k WHEN 0 THEN 2 WHEN 1 THEN 2 ELSE 0 END AS n_items FROM x""")
def _(spark, d):
    zero = say("Header\n001 1 EA ", name(), " 10.00 10.00\n in ", kind(), "\n\nPage 1\njunk\n 002 1,000 LOT second ", name(), " 0.1250 125.00\nTotal Order: 5\nmore junk\n003 2 EA second ", name(), " 1.00")
    one = say("text before 001 2 EA one ", name(), " 3.00 6.00 002 1 CS two ", name(), " 1.00 1.00 text behind")
    # An item that is too long is cut, and then it has no list.
    two = say("001 1 EA long ", name(), " 10.00 10.00\n", F.repeat(F.lit("word "), F.lit(1000)))
    return parsed(spark, d, F.when(case() == 0, zero).when(case() == 1, one).when(case() == 2, two).otherwise(say("01 1 EA ", name(), " 10.00 10.00")))


@query("F11_F12_table_items", TEXT_SQL + """CASE WHEN k <> 3 THEN 'line_items' END AS source, CASE k WHEN 0 THEN n || ' DARK GREEN; BRUSHES, ' || n WHEN 1 THEN n WHEN 2 THEN n || '; last ' || n END AS description, CASE k WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 0 END AS n_items FROM x""")
def _(spark, d):
    zero = say("x Line  Description 1 ", name(), " 2.0000 CS 3.0000 6.00 DARK\nGREEN 2 BRUSHES, ", name(), " 1.0000 EA 2.0000 2.00 STATE OF NEBRASKA foo Total Order 8.00 3 no row 1.0000 EA 1.0000 1.00")
    # A tail that is too long, or that carries columns of a row, isn't a description's.
    one = say("Line Description 1 ", name(), " 2.0000 CS 3.0000 6.00 ", F.repeat(F.lit("tail "), F.lit(90)), " Page 1 of 2")
    two = say("Line Description 12 ", name(), " 2.0000 CS 3.0000 1,006.00 rest 9.1234 2 last ", name(), " 1.0000 EA 1.0000 1.00 Page 2 of 2")
    return parsed(spark, d, F.when(case() == 0, zero).when(case() == 1, one).when(case() == 2, two).otherwise(say("Line Description 1 ", name(), " 2.00 CS 3.0000 6.00")))


@query("F8_purchasing_bureau", TEXT_SQL + """CASE WHEN k > 0 THEN 'purchasing_bureau' END AS source, CASE k WHEN 1 THEN 'Contract to supply and deliver ' || n || ' gravel for the State.' WHEN 2 THEN 'One Time Purchase to furnish ' || n || ' and ' || t || ' goods' WHEN 3 THEN 'Purchase Order to provide ' || n || ' a b c' END AS description, 0 AS n_items FROM x""")
def _(spark, d):
    one = say("x\nContract to supply and deliver Contract to supply and deliver ", name(), " gravel\nfor the State.\nVendor  Contact: none\nmore")
    two = say("One Time Purchase to furnish ", name(), " and ", kind(), " goods IMPORTANT NOTE: read this\nand that")
    # Four lines carry it on at most, the end of its own among them; too short is none.
    three = say("Purchase Order to provide ", name(), "\na\nb\nc\nd\ne")
    return parsed(spark, d, F.when(case() == 1, one).when(case() == 2, two).when(case() == 3, three).otherwise("Contract to supply it"))


@query("F13_contract_description", TEXT_SQL + """CASE WHEN k > 0 THEN 'contract_description' END AS source, CASE k WHEN 1 THEN 'GRAD ' || n || ' — I-80, ' || t WHEN 2 THEN 'GRAD at ' || t || ' ' || n WHEN 3 THEN 'GRAD ' || n END AS description, 0 AS n_items FROM x""")
def _(spark, d):
    one = say("Primary Project Location: I-80, ", kind(), "   Contract Description: GRAD ", name(), "   Vendor: x")
    two = say("Contract Description: GRAD at ", kind(), " ", name(), " Letting Date: 1/2/2024 Primary Project Location: ", kind(), "  Vendor: x")
    three = say("Contract Description: GRAD ", name(), " Primary Project Location: Letting Date: 1/2/2024")
    return parsed(spark, d, F.when(case() == 1, one).when(case() == 2, two).when(case() == 3, three).otherwise(say("Contract Description: GRAD ", name(), " Vendor: x")))


@query("F14_A7_A18_scope", f"""WITH x AS (SELECT p_partkey, p_partkey % 6 AS k, p_name AS n FROM part), s AS (SELECT CASE k WHEN 0 THEN 'direct_purchase' WHEN 1 THEN 'cover_sheet' WHEN 2 THEN 'contract_description' END AS source, CASE k WHEN 0 THEN length('{NOTICE} ') + length(n) WHEN 1 THEN length(n) WHEN 2 THEN 5 + length(n) END AS size FROM x WHERE k < 4)
SELECT source, count(*) AS n, list_sort(list(size))[count(*) // 2 + 1] AS median, max(size) AS longest FROM s WHERE source IS NOT NULL GROUP BY 1 UNION ALL SELECT 'status ' || CASE WHEN k < 4 THEN 'text' WHEN k = 4 THEN 'scanned' ELSE 'error' END, count(*), NULL, NULL FROM x GROUP BY 1""")
def _(spark, d):
    k = key() % 6
    notice, sheet = say(NOTICE, " ", name()), say("Contract Summary event name) ", name(), " Start Date")
    # A text that several parsers accept goes to the first of them.
    highway = say("Primary Project Location: Letting Date: x Contract Description: GRAD ", name(), " Vendor: x")
    text = F.when(k == 0, say(notice, F.lit(""))).when(k == 1, say(sheet, " ", highway)).when(k == 2, highway).when(k == 3, "nothing")
    status = F.when(k < 4, "text").when(k == 4, "scanned").otherwise("error")
    log = t(spark, d, "part").select(key().cast("string").alias("tok"), F.struct(status.alias("status"), F.lit("d").alias("doc"), text.alias("text")).alias("data"))
    tally = extraction.status_tally(log).select(F.concat(F.lit("status "), "status").alias("source"), "n", F.lit(None).cast("int").alias("median"), F.lit(None).cast("int").alias("longest"))
    return extraction.report(extraction.scope(log)).unionByName(tally)


BLANKS = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query("F1_flatten", rf"SELECT doc_id, trim(regexp_replace(text || chr(8232) || chr(160) || 'x ', '{BLANKS}', ' ', 'g')) AS flat FROM documents")
def _(spark, d):
    return t(spark, d, "documents").select("doc_id", N.flatten(F.concat("text", F.lit("  x "))).alias("flat"))


@query("P14_display_name", "SELECT p_partkey, p_name || ' & co' AS shown, p_name || chr(9) || chr(1) || ' & ' || chr(10) || 'co ' AS vendor FROM part")
def _(spark, d):
    vendor = F.concat(name(), F.lit("\t\u0001 & \nco "))
    return t(spark, d, "part").select("p_partkey", N.display_name(vendor).alias("shown"), vendor.alias("vendor"))


@query("O7_capped", "SELECT doc_id, left(text, 400) AS text, length(text) > 400 AS clipped FROM documents")
def _(spark, d):
    return t(spark, d, "documents").select("doc_id", N.capped(F.col("text"), 400).alias("c")).select("doc_id", "c.text", "c.clipped")


@query("F22_summaries_in_and_out", "SELECT CAST(doc_id AS VARCHAR) AS tok, length(left(text, 400)) AS asked, doc_id % 3 = 0 AS unclear, CASE WHEN doc_id % 3 > 0 THEN 'About ' || lang END AS summary FROM documents")
def _(spark, d):
    asked = extraction.summary_inputs(t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("tok"), "text", "lang"), 400)
    answers = asked.select("tok", F.when(F.col("tok").cast("long") % 3 == 0, " Unclear.").otherwise(F.concat(F.lit(" About "), "lang", F.lit("\n "))).alias("answer"))
    return asked.select("tok", F.length("prompt").alias("asked")).join(extraction.summary_results(answers.withColumn("answer", F.regexp_replace("answer", r"\s+\z", ""))), "tok")


@query("F25_highlight", """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN replace(replace(p_name, 'plate', '<mark>plate</mark>'), 'red', '<mark>red</mark>') || ' &amp; &lt;co&gt;' ELSE replace(replace(p_name, 'red plate', '<mark>red plate</mark>'), 'x', 'x') || ' co' END AS shown FROM part WHERE p_name NOT LIKE '%plate%' OR p_name = 'red plate' OR p_partkey % 2 = 0""")
def _(spark, d):
    rows = t(spark, d, "part").where("p_name not like '%plate%' or p_name = 'red plate' or p_partkey % 2 = 0")
    apart = S.highlighted(F.concat(name(), F.lit(" & <co>")), "plate  red")
    # Typed in the name's order it is one run; of the words alone 'red' and 'plate' would be marked each.
    run = S.highlighted(F.concat(name(), F.lit(" co")), "RED plate")
    whole = F.when(name() == "red plate", run).otherwise(F.concat(name(), F.lit(" co")))
    return rows.select("p_partkey", F.when(key() % 2 == 0, apart).otherwise(whole).alias("shown"))


@query("F27_same_geometry", "SELECT doc_id, doc_id % 4 < 3 AND length(text) > 0 OR doc_id % 4 < 2 AS same FROM documents WHERE length(text) > 60 AND regexp_matches(left(text, 60), '^[A-Za-z]')")
def _(spark, d):
    rows = t(spark, d, "documents").where("length(text) > 60").where(F.left("text", F.lit(60)).rlike("^[A-Za-z]"))
    k = F.col("doc_id") % 4
    other = F.when(k == 0, F.concat(F.lit(" "), "text", F.lit("\t"))).when(k == 1, F.concat(F.lit(" \n"), "text")).when(k == 2, F.left("text", F.lit(55))).otherwise(F.concat(F.lit("0"), "text"))
    return rows.select("doc_id", S.same_geometry(F.lower("text"), F.lower(other)).alias("same"))


@query("X15_right_of_label", "SELECT p_partkey AS page, p_name || ' ' || p_brand AS value FROM part WHERE p_partkey % 5 <> 0")
def _(spark, d):
    # A page: a title, a label whose value stands right of it (its words a little higher or lower), another line, a footer.
    word = lambda text, x, y: F.struct(text.alias("text") if isinstance(text, Column) else F.lit(text).alias("text"), F.lit(x).cast("double").alias("x0"), F.lit(x + 40).cast("double").alias("x1"), F.lit(y).cast("double").alias("top"), F.lit(y + 10).cast("double").alias("bottom"))
    first, second = F.split(name(), " ")[0], F.split(name(), " ")[1]
    label = F.when(key() % 5 != 0, "Purchase:").otherwise("Vendor:")
    words = F.array(word("Cover", 10, 10), word("Description", 10, 100), word("of", 60, 100), word(label, 110, 100), word(second, 210, 102), word(first, 160, 99), word(F.col("p_brand"), 260, 100), word("left", 0, 120), word("below", 200, 112), word("Page", 300, 400))
    boxes = t(spark, d, "part").select(key().alias("page"), F.explode(words).alias("b")).select("page", "b.*")
    return S.right_of_label(boxes, ["description", "of", "purchase:"])


@query("F16_packed_documents", "SELECT p_size AS size, count(*) AS n, CAST(sum(12 + octet_length(encode(p_name || 'é')) + octet_length(encode('t' || p_partkey)) + 4) AS INTEGER) AS bytes, true AS same FROM part GROUP BY 1")
def _(spark, d):
    fields = ("name", "size", "token")
    file = F.struct(F.concat(name(), F.lit("é")).alias("name"), F.lit("1 KB").alias("size"), F.concat(F.lit("t"), key().cast("string")).alias("token"))
    lists = t(spark, d, "part").groupBy(F.col("p_size").alias("size")).agg(F.sort_array(F.collect_list(file)).alias("files")).withColumn("raw", N.packed_list(F.col("files"), *fields))
    back = N.unpacked_list(F.col("raw"), *fields)
    return lists.select("size", F.size("files").cast("long").alias("n"), F.octet_length("raw").alias("bytes"), (back == F.col("files")).alias("same"))


@query("F17_varint_postings", """WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents), p AS (SELECT word, doc_id * 300 + 5 AS id FROM w WHERE length(word) >= 2), g AS (SELECT word, id - coalesce(lag(id) OVER (PARTITION BY word ORDER BY id), 0) AS gap FROM p)
SELECT word, count(*) AS n, CAST(sum(CASE WHEN gap < 128 THEN 1 WHEN gap < 16384 THEN 2 WHEN gap < 2097152 THEN 3 ELSE 4 END) AS INTEGER) AS bytes, true AS same FROM g GROUP BY 1 HAVING count(*) <= 500""")
def _(spark, d):
    from ..operators import index

    words = index.postings(t(spark, d, "documents"), "text", "doc_id").groupBy("word").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.col("row_id") * 300 + 5)).alias("ids")).where("n <= 500")
    raw = words.withColumn("raw", N.varint_deltas(F.col("ids")))
    return raw.select("word", "n", F.octet_length("raw").alias("bytes"), (N.from_varint_deltas(F.col("raw")) == F.col("ids")).alias("same"))


@query("F21_run_code", "SELECT event_type, user_id, CASE WHEN count(*) FILTER (value > 40) * 2 > count(*) THEN 2 ELSE 0 END AS code FROM events GROUP BY 1, 2")
def _(spark, d):
    runs = t(spark, d, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("total"), F.count_if(F.col("value") > 40).alias("errors"))
    return runs.select("event_type", "user_id", P.run_code(F.col("total"), F.col("errors")).alias("code"))


@query("P17_P18_retry", "SELECT event_id, event_type = 'error' AND event_id % 3 <> 0 AS again, event_id % 4 = 0 OR (event_id % 5 = 0 AND event_id % 2 = 0) AS failed FROM events")
def _(spark, d):
    k = F.col("event_id")
    status = F.when(F.col("event_type") == "error", "unavailable").otherwise("text")
    detail = F.when(k % 3 == 0, "got HTTP 404").when(k % 3 == 1, "timeout")
    error = lambda bad: F.when(bad, "crash")
    engines = F.when(k % 4 == 0, F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.lit("a"), error(k % 5 == 0), F.lit("b"), error(k % 2 == 0)))
    return t(spark, d, "events").select("event_id", P.never_proven_absent(status, detail).alias("again"), P.all_failed(engines).alias("failed"))


@query("P13_shown_end", f"WITH {RECORDS_SQL} SELECT row_id, CASE row_id % 9 WHEN 0 THEN 'open-ended' WHEN 1 THEN 'open-ended' ELSE CAST(end_ AS VARCHAR) END AS shown, row_number() OVER (ORDER BY CASE row_id % 9 WHEN 0 THEN 20991231 WHEN 1 THEN 20990101 ELSE end_ END, row_id) - 1 AS place FROM records")
def _(spark, d):
    end = F.when(F.col("row_id") % 9 == 0, 20991231).when(F.col("row_id") % 9 == 1, 20990101).otherwise(F.col("end"))
    # Sorted on what was recorded, not on what is shown.
    return fold.numbered(records(spark, d).select("row_id", end.alias("end")), ["end", "row_id"], "place").select("row_id", P.shown_end(F.col("end")).alias("shown"), "place")


@query("P4_rebuilt_urls", f"WITH {RECORDS_SQL} SELECT row_id, 'https://h/S?DN=' || doc_number || '%2B%2F%3D&V=' || replace(vendor, '#', '%23') || '%20%C3%A9' AS url, true AS same FROM records")
def _(spark, d):
    r = records(spark, d)
    rebuilt = N.rebuilt_url(F.lit("https://h/S"), DN=F.concat("doc_number", F.lit("+/=")), V=F.concat("vendor", F.lit(" é")))
    again = N.rebuilt_url(F.lit("https://h/S"), DN=N.query_param(F.col("url"), "DN"), V=N.query_param(F.col("url"), "V"))
    return r.select("row_id", rebuilt.alias("url")).select("row_id", "url", (again == F.col("url")).alias("same"))


@query("P5_view_suffix", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '' ELSE 'D=' || md5(url) END AS token FROM pages")
def _(spark, d):
    view = F.when(F.col("page_id") % 3 == 0, "").otherwise(F.concat(F.lit("https://h/View?D="), F.md5("url")))
    return t(spark, d, "pages").select("page_id", N.view_suffix(view, "https://h/View?").alias("token"))


STATE = search.Query(vendor="customer#00000004", agencies=["NATION_1", "NATION_2", "NATION_3"], types=["HIGH", "LOW"], status="Active", year_from=1996, year_to=1999, least="$20,000", most="450000", when="", sort="vendor", ascending=True)


@query("P8_P10_O2_F32_search", f"""WITH {RECORDS_SQL} SELECT row_id, vendor, amount_value FROM records WHERE contains(lower(vendor), 'customer#0000000') AND entity_name IN ('NATION_1', 'NATION_2', 'NATION_3') AND split_part(doc_type, '-', 2) IN ('HIGH', 'LOW') AND status = 'Active' AND begin_ BETWEEN 19960101 AND 19991231 AND amount_value BETWEEN 20000 AND 450000""")
def _(spark, d):
    # The state goes through its permalink and back before it is asked.
    state = search.Query.parsed("?" + search.Query(**(vars(STATE) | {"vendor": "customer#0000000"})).permalink())
    rows = records(spark, d).withColumn("type_group", F.split("doc_type", "-")[1])
    return search.search(rows, state, AS_OF).select("row_id", "vendor", "amount_value")


@query("P8_F26_word_search", """WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents) SELECT doc_id AS row_id, lang AS vendor FROM documents WHERE doc_id IN (SELECT doc_id FROM w WHERE word = 'the') AND doc_id IN (SELECT doc_id FROM w WHERE word LIKE 'th%' AND length(word) > 2) AND lang = 'en'""")
def _(spark, d):
    from ..operators import index

    docs = t(spark, d, "documents")
    rows = docs.select(F.col("doc_id").alias("row_id"), F.col("lang").alias("vendor"), F.lit("E").alias("entity_name"), F.lit(0).alias("begin"), F.lit(0).alias("end"), F.col("n_chars").cast("double").alias("amount_value"), F.when(F.col("lang") == "en", "Active").otherwise("Expired").alias("status"))
    return search.search(rows, search.Query(words="The th", status="Active"), AS_OF, index.postings(docs, "text", "doc_id")).select("row_id", "vendor")


@query("P15_unknown_values", "SELECT v AS value FROM (VALUES ('NATION_99'), ('Nation_1'), ('')) x(v)")
def _(spark, d):
    names = t(spark, d, "nation")
    unknown = P.unknown_values(names, "n_name", ["NATION_1", "NATION_99", "Nation_1", "NATION_2", ""])
    return spark.createDataFrame([(v,) for v in unknown], "value string")


@query("O3_prioritised", "SELECT n_name, row_number() OVER (ORDER BY CASE n_name WHEN 'NATION_9' THEN 1 WHEN 'NATION_2' THEN 2 ELSE 3 END, n_name) - 1 AS place FROM nation")
def _(spark, d):
    return search.prioritised(t(spark, d, "nation").select("n_name"), "n_name", ["NATION_9", "NATION_2"]).select("n_name", "place")


@query("F30_since", "SELECT user_id, count(*) AS n, DATE '2024-01-20' AS since FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-20' GROUP BY 1")
def _(spark, d):
    today = date(2024, 1, 30)
    first, same = nightly.since("10", today), nightly.since("2024-01-20", today)
    if first != same:
        raise ValueError("a number of days and its date differ")
    e = t(spark, d, "events").where(F.to_date("ts") >= F.lit(first))
    return e.groupBy("user_id").agg(F.count("*").alias("n")).withColumn("since", F.lit(first))


def listed(spark: SparkSession, d: str) -> DataFrame:
    """Rows with documents: each order carries the files of its lines, in line order; orders with one file only a view token."""
    line = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set(F.struct("l_linenumber", "l_partkey"))).alias("ls"))
    files = F.transform("ls", lambda x: F.struct(F.concat(F.lit("t"), (x["l_partkey"] % 500).cast("string")).alias("token"), x["l_linenumber"].alias("line")))
    first = line.select(F.col("l_orderkey").alias("row_id"), F.array_distinct(F.transform(files, lambda x: x["token"])).alias("tokens"))
    return first.select("row_id", F.element_at("tokens", 1).alias("view_token"), F.transform("tokens", lambda x: F.struct(x.alias("token"))).alias("documents"))


LISTED_SQL = """WITH f AS (SELECT l_orderkey AS row_id, 't' || (l_partkey % 500) AS token, min(struct_pack(a := l_linenumber, b := l_partkey)) AS o FROM lineitem GROUP BY 1, 2),
pos AS (SELECT row_id, token, CAST(row_number() OVER (PARTITION BY row_id ORDER BY o) - 1 AS INTEGER) AS position FROM f)"""


@query("J9_W15_X2_positions", LISTED_SQL + " SELECT token, row_id, position, position = 0 AS is_primary FROM pos")
def _(spark, d):
    return documents.positions(listed(spark, d))


@query("J15_extra_targets", LISTED_SQL + " SELECT p.row_id, p.position, p.token, CAST(substr(h.token, 2) AS INTEGER) % 3 = 0 AS first_described FROM pos p JOIN pos h ON h.row_id = p.row_id AND h.position = 0 WHERE p.position > 0")
def _(spark, d):
    done = t(spark, d, "lineitem").where("l_partkey % 500 % 3 = 0").select(F.concat(F.lit("t"), (F.col("l_partkey") % 500).cast("string")).alias("token"))
    return documents.extra_targets(listed(spark, d), done)


@query("J10_W10_X17_summaries", LISTED_SQL + """, s AS (SELECT 't' || (doc_id % 500) AS token, doc_id AS seq, 'about ' || doc_id AS summary, CASE WHEN doc_id % 2 = 0 THEN 'm1' ELSE 'm2' END AS model FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0)
SELECT row_id, summary, model, position FROM (SELECT p.row_id, summary, model, position, row_number() OVER (PARTITION BY p.row_id ORDER BY position, seq DESC) AS k FROM s JOIN pos p USING (token)) WHERE k = 1""")
def _(spark, d):
    rows = listed(spark, d)
    k = F.col("doc_id")
    answers = t(spark, d, "documents").select(
        F.concat(F.lit("t"), (k % 500).cast("string")).alias("tok"), k.alias("seq"), F.when(k % 7 != 0, F.concat(F.lit("about "), k.cast("string"))).alias("summary"), (k % 11 == 0).alias("unclear"), F.when(k % 2 == 0, "m1").otherwise("m2").alias("model")
    )
    return documents.summarised(rows.select("row_id", "view_token"), documents.positions(rows), answers, documents.known_models(answers))
