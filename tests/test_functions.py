"""Normalisation, predicates, parsers and search against known answers."""

import hashlib
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import normalize as N
from ledgerline.functions import parsers, search
from ledgerline.functions import predicates as P


def values(spark, column_of, texts, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], f"i int, x {kind}")
    return [r.v for r in df.select("i", column_of(F.col("x")).alias("v")).orderBy("i").collect()]


def test_money(spark):
    texts = ["$4,920.00", "", "N/A", "NaN", "inf", "  $0.00 ", "-5", "$38,000,000,000.00", "1_000", "1.5d", "1e3", None, "1 000"]
    assert values(spark, N.money, texts) == [4920.0, 0.0, 0.0, 0.0, 0.0, 0.0, -5.0, 38e9, 1000.0, 0.0, 1000.0, 0.0, 0.0]


def test_date_int(spark):
    assert values(spark, N.date_int, ["08/13/2026", "9/3/2024", "", "1/2", "13/45/2020", "a/b/c", "1/2/2223", None]) == [20260813, 20240903, 0, 0, 20201345, 0, 22230102, 0]
    assert [str(x) for x in values(spark, N.real_date, ["9/3/2024", "13/45/2020", ""])] == ["2024-09-03", "None", "None"]


def test_bound_is_null_unless_a_number(spark):
    assert values(spark, N.bound, ["$1,000", "many", "", "5"]) == [1000.0, None, None, 5.0]


def test_url_parameters_and_rebuild(spark):
    assert values(spark, lambda c: N.query_param(c, "DN"), ["https://h/p?A=1&DN=a%2Bb%2F%3D", "https://h/p", "https://h/p?DN="]) == ["a+b/=", "", ""]
    assert values(spark, lambda c: N.rebuilt_url(F.lit("https://h/p"), A=c), ["a b+/="]) == ["https://h/p?A=a%20b%2B%2F%3D"]


def test_view_suffix_refuses_another_prefix(spark):
    assert values(spark, lambda c: N.view_suffix(c, "https://h/"), ["https://h/x", ""]) == ["x", ""]
    with pytest.raises(Exception, match="unexpected view URL"):
        values(spark, lambda c: N.view_suffix(c, "https://h/"), ["http://other/"])


def test_shard_of_is_the_whole_md5(spark):
    texts = ["abc", "", "x" * 100]
    assert values(spark, lambda c: N.shard_of(c, 7), texts) == [int(hashlib.md5(t.encode()).hexdigest(), 16) % 7 for t in texts]


def test_vendor_key(spark):
    assert values(spark, N.vendor_key, ["Acme Paving, Inc.", "ACME PAVING CO 12345", "The Acme Paving Company", "LLC", "A & B"]) == ["ACME PAVING", "ACME PAVING", "ACME PAVING", "", "A B"]


def test_small_functions(spark):
    assert values(spark, N.shard_letter, [" acme", "3M", "", "é"]) == ["A", "_", "_", "_"]
    assert values(spark, N.index_words, ["The cat the CAT a é7x"]) == [["the", "cat", "7x"]]
    assert values(spark, N.clamp_count, [None, 0, 300], "int") == [255, 0, 254]
    assert values(spark, N.csv_guard, ["=1+1", "x", "-2", "@a"]) == ["'=1+1", "x", "'-2", "'@a"]
    assert values(spark, N.display_name, ["a \t\u0000 b c "]) == ["a b c"]
    assert values(spark, N.flatten, [" a \n b "]) == ["a b"]
    assert values(spark, lambda c: N.capped(c, 3)["text"], ["abcd"]) == ["abc"]
    assert values(spark, lambda c: N.strict_timestamp(c).isNotNull(), ["2026-01-02T03:04:05Z", "2026-01-02T03:04:05+01:00", "2026-01-02T03:04:05"]) == [True, True, False]
    assert values(spark, lambda c: F.length(N.key_hash(c)), ["https://h", "0" * 24]) == [24, 24]


def test_night_begins_at_local_noon(spark):
    got = values(spark, lambda c: N.night_of(F.to_timestamp(c)).cast("string"), ["2026-07-01T16:59:00Z", "2026-07-01T17:01:00Z"])
    assert got == ["2026-06-30", "2026-07-01"]


@pytest.mark.parametrize(("preset", "day", "want"), [("began30", 20261010, True), ("began30", 20261009, False), ("began30", 0, False), ("began365", 0, True)])
def test_windows(spark, preset, day, want):
    assert values(spark, lambda c: P.in_window(preset, c, c, F.lit("2026-11-09").cast("date")), [day], "long") == [want]


def test_undated_rows_stay_in_year_bounds(spark):
    assert values(spark, lambda c: P.in_years(c, 2020, 2021), [0, 20191231, 20200101, 20211231, 20220101], "long") == [True, False, True, True, False]


def test_verdicts(spark):
    assert values(spark, lambda c: P.text_verdict(c, F.lit(1)), [49, 50, 51], "int") == ["scanned", "text", "text"]
    assert values(spark, lambda c: P.non_pdf_verdict(c, F.lit(b"x"))["status"], ["image/tiff", "text/html", None]) == ["unsupported", "error", "error"]
    assert values(spark, lambda c: P.never_proven_absent(F.lit("unavailable"), c), ["got 404", "timeout", None]) == [False, True, True]
    assert values(spark, lambda c: P.run_code(c, F.lit(2)), [0, 3, 4], "int") == [0, 2, 0]


VENDORS = [
    ("je dunn", "J.E. DUNN CONSTRUCTION COMPANY", True), ("j.e. dunn", "JE DUNN CONSTRUCTION CO", True), ("jedunn", "J.E DUNN CONSTRUCTION COMPANY", True), ("je dunn const", "J.E. DUNN CONSTRUCTION COMPANY", True),
    ("u.s. bank", "US BANK NATIONAL ASSOCIATION", True), ("o'neill", "ONEILL AUTO SUPPLY INC", True), ("oneill", "O NEILL, JESSICA JANAE", True), ("hy-vee", "HYVEE, OMAHA", True), ("john smith", "SMITH, JOHN W", True),
    ("blue cross blue shield", "BLUE CROSS AND BLUE SHIELD OF NEBRASKA", True), ("roche diagnostics", "ROCHEDIAGNOSTICSCORPORATION", True), ("at&t", "AT & T", True), ("mart", "WALMART STORE 2432", True),
    ("at&t", "ATTORNEY GENERAL", False), ("at&t", "AT HOME TILE", False), ("3m", "OPTION 3 MATERIAL HANDLING LLC", False), ("hdr", "T & H DRYWALL SERVICES INC", False), ("mcdonald's", "MCDONALD, STEPHANIE", False),
    ("d & d", "R & D SYST INC", False), ("blue blue", "BLUE CROSS", False), ("wal mart", "MARTHA WALLACE", False), ("art supply", "MEDSUPPLY PARTNERS", False),
]


def test_vendor_search_known_answers(spark):
    for typed, name, want in VENDORS:
        assert values(spark, lambda c, typed=typed: search.vendor_matches(c, typed), [name]) == [want], (typed, name)


def test_agency_search_known_answers(spark):
    aliases = {"dot": ["Roads, Department of"], "department of transportation": ["Roads, Department of"], "ag": ["Attorney General"]}
    cases = [
        ("Roads, Department of", "roads", True), ("Roads, Department of", "dot", True), ("Roads, Department of", "department of transportation", True), ("Roads, Department of", "dhhs", False),
        ("Health & Human Services, Department of", "health and human", True), ("Attorney General", "ag", True), ("Educational Telecommunications Commission", "ag", False),
    ]
    for name, typed, want in cases:
        assert values(spark, lambda c, typed=typed: search.agency_matches(c, typed, aliases), [name]) == [want], (typed, name)


def test_highlight_known_answers(spark):
    cases = [
        ("john smith", "SMITH, JOHN W", "<mark>SMITH</mark>, <mark>JOHN</mark> W"), ("je dunn", "J.E. DUNN & CO", "<mark>J.E. DUNN</mark> &amp; CO"), ("dunn", "J.E. DUNN & CO", "J.E. <mark>DUNN</mark> &amp; CO"),
    ]
    for typed, name, want in cases:
        assert values(spark, lambda c, typed=typed: search.highlighted(c, typed), [name]) == [want]


def test_verbatim(spark):
    assert values(spark, lambda c: search.is_verbatim(c, F.lit("one two  three four")), ["one three", "three one", ""]) == [True, False, True]


FORM = "\n".join(["CONTRACT COVER SHEET", "UNIVERSITY OF NEBRASKA", "CONTRACT TYPE", "SUPPLIER NAME", "DESCRIPTION OF", "PURCHASE", "DOLLAR AMOUNT", "BUYER NAME", "Acme Co", "Travel services", "$4,000.00", "B. Uyer"])
TEXTS = {
    "direct_purchase": "This item involved a direct purchase which did not result in a contract. Therefore nothing.",
    "cover_sheet": "Contract Summary (brief description and/\n or event\n name)  Snow removal\n on campus  Purchase Category x",
    "cover_sheet_form": FORM,
    "services_clause": "Intro 2. SERVICES The firm shall provide cleaning of all the windows in the hall. 3. DELIVERY later",
    "line_items": "001 1 EA GENERAL SERVICES FOR 10.00 10.00\nREMODEL OF HALL\n\nPage 1\njunk\n002 2 EA FREE SAMPLE 0.00",
    "purchasing_bureau": "x\nContract to supply and deliver Contract to supply and deliver Armor Coat gravel\nfor the State.\nVendor Contact: none",
    "contract_description": "Primary Project Location: I-80, East   Contract Description: GRAD SEED BR   Vendor: x",
}
WANT = {
    "direct_purchase": "This item involved a direct purchase which did not result in a contract. Therefore nothing.",
    "cover_sheet": "Snow removal on campus",
    "cover_sheet_form": "Travel services",
    "services_clause": "The firm shall provide cleaning of all the windows in the hall.",
    "line_items": "GENERAL SERVICES FOR REMODEL OF HALL; FREE SAMPLE",
    "purchasing_bureau": "Contract to supply and deliver Armor Coat gravel for the State.",
    "contract_description": "GRAD SEED BR — I-80, East",
}


def test_parser_chain(spark):
    df = spark.createDataFrame([(k, v) for k, v in TEXTS.items()] + [("none", "nothing here"), ("null", None), ("quoted", "He wrote: This item involved a direct purchase which did not result in a contract.")], "k string, text string")
    got = {r.k: (r.source, r.description) for r in parsers.described(df).collect()}
    for k, want in WANT.items():
        assert got[k] == (k, want)
    assert got["none"] == got["null"] == got["quoted"] == (None, None)


def test_state_rows_take_their_tails():
    text = "x Line Description 1 PAINT, OUTDOOR 2.0000 CS 3.0000 6.00 DARK GREEN 2 BRUSHES 1.0000 EA 2.0000 2.00 STATE OF NEBRASKA foo Total Order 8.00"
    assert parsers.item_rows(text) == ["PAINT, OUTDOOR DARK GREEN", "BRUSHES"]


def test_registered_parser_comes_at_its_rank(spark):
    chain = parsers.registered("all", 0, lambda c: F.upper(c))
    df = spark.createDataFrame([("a",)], "text string")
    assert parsers.described(df, "text", chain).first().description == "A"


def test_packed_lists_of_any_length(spark):
    item = F.struct(F.concat(F.lit("é"), F.col("id").cast("string")).alias("a"), F.repeat(F.lit("x"), (F.col("id") % 3).cast("int")).alias("b"))
    packed = lambda n: spark.range(n, numPartitions=1).agg(F.sort_array(F.collect_list(item)).alias("l")).withColumn("raw", N.packed_list(F.col("l"), "a", "b"))
    began = time.monotonic()
    for n in (0, 1, 2, 20_000):
        assert packed(n).select((N.unpacked_list(F.col("raw"), "a", "b") == F.col("l")).alias("same"), F.size(N.unpacked_list(F.col("raw"), "a", "b")).alias("n")).first() == (True, n)
    assert time.monotonic() - began < 60
    # Too few bytes, some left over, a string left over, a length beyond the bytes or any array, nothing.
    raws = [(bytearray(x),) for x in (b"\0\0\0\2a", b"\0\0\0\1ab", b"\0\0\0\1a\0\0\0\0\0\0\0\1c", b"\0\0", b"\x7f\xff\xff\xffa", b"\xff\xff\xff\xffa")] + [(None,)]
    assert {r[0] for r in spark.createDataFrame(raws, "raw binary").select(N.unpacked_list(F.col("raw"), "a", "b")).collect()} == {None}
