"""Folds, duplicates, joins, differences and guards on tiny tables."""

import datetime as dt
import time
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import dedup, diff, documents, fold, guards, index, reports, vendors


def rows_of(df, *cols):
    return sorted(tuple(r) for r in df.select(*(cols or df.columns)).collect())


def test_latest_does_not_depend_on_input_order(spark):
    rows = [(k, s, f"{k}{s}") for k in "abc" for s in range(5)]
    want = [("a", 4, "a4"), ("b", 4, "b4"), ("c", 4, "c4")]
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        assert rows_of(fold.latest(spark.createDataFrame(rows, "k string, s int, v string"), ["k"], "s")) == want


def test_latest_keeps_nulls_of_the_last_row(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None)], "k string, s int, v string")
    assert rows_of(fold.latest(df, ["k"], "s")) == [("a", 2, None)]


def test_best_by_rank_prefers_low_ranks_then_later_lines(spark):
    df = spark.createDataFrame([("a", 1, 1, "w"), ("a", 0, 2, "x"), ("a", 0, 3, "y"), ("b", 5, 1, "z")], "k string, rank int, seq int, v string")
    assert rows_of(fold.best_by_rank(df, ["k"], "rank", "seq"), "k", "v") == [("a", "y"), ("b", "z")]


def test_numbered_is_dense_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(5)
    assert rows_of(fold.numbered(df, ["x"])) == [(i, i) for i in range(1000)]
    assert fold.numbered(df.limit(0), ["x"]).count() == 0


def test_first_seen_index_and_islands(spark):
    df = spark.createDataFrame([(3, "b"), (1, "b"), (2, "a")], "s int, v string")
    assert rows_of(fold.first_seen_index(df, "v", "s"), "v", "idx") == [("a", 1), ("b", 0)]
    runs = spark.createDataFrame([("e", i, h) for i, h in enumerate([True, True, False, True])], "g string, i int, h boolean")
    assert rows_of(fold.islands(runs, ["g"], ["i"], F.col("h"))) == [("e", 0, 1, 2), ("e", 3, 3, 1)]


def record(seq, **kw):
    base = {"doc_number": "A-1", "doc_type": "O4", "entity_code": "1", "entity_name": "Roads", "vendor": "ACME", "amount": "$1.00", "begin_date": "1/2/2024", "end_date": "", "status": "Active", "detail_url": "u1", "view_url": ""}
    return {**base, **kw, "seq": seq}


def frame(spark, rows):
    names = list(record(0))
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} {'int' if n == 'seq' else 'string'}" for n in names))


def test_exact_twin_and_stale(spark):
    rows = frame(spark, [record(1), record(2), record(3, status="Expired"), record(4, status="Expired", amount="$2.00", doc_type="X"), record(5, status="Expired", detail_url="u2"), record(6, status="Expired", detail_url="")])
    one = dedup.exact(rows)
    assert rows_of(one, "seq") == [(1,), (3,), (4,), (5,), (6,)]
    two = dedup.without_twins(one)
    assert rows_of(two, "seq") == [(1,), (4,), (5,), (6,)]
    assert rows_of(dedup.without_stale(two), "seq") == [(1,), (5,), (6,)]


def test_document_joins(spark):
    rows = spark.createDataFrame([(1, "k1", "t0", [("n", "s", "t0"), ("n", "s", "t1")]), (2, "k2", "t2", None), (3, "k3", "", None)], "row_id int, k string, view_token string, documents array<struct<name:string,size:string,token:string>>")
    places = documents.positions(rows)
    assert rows_of(places) == [("t0", 1, 0, True), ("t1", 1, 1, False), ("t2", 2, 0, True)]
    scope = spark.createDataFrame([("t1", "line_items", "second", 9), ("t0", "new_thing", "first", 1), ("t2", "cover_sheet", "old", 1), ("t2", "cover_sheet", "newer", 2), ("zz", "x", "y", 1)], "tok string, source string, description string, seq int")
    assert rows_of(documents.described(places, scope)) == [(1, "first", "unknown", 0), (2, "newer", "cover_sheet", 0)]
    log = spark.createDataFrame([("k1", 2, None), ("k2", 0, None)], "k string, n int, documents array<string>")
    assert rows_of(documents.with_counts(rows.select("row_id", "k"), log), "row_id", "n") == [(1, 2), (2, 0), (3, None)]
    targets = documents.extra_targets(rows.select("row_id", "documents"), spark.createDataFrame([("t0",)], "token string"))
    assert rows_of(targets) == [(1, 1, "t1", True)]


def test_summaries(spark):
    rows = spark.createDataFrame([(1, "t0"), (2, "t0"), (3, "t3")], "row_id int, view_token string")
    places = spark.createDataFrame([("t0", 1, 0, True), ("t1", 1, 1, False), ("t3", 3, 0, True)], "token string, row_id int, position int, is_primary boolean")
    s = spark.createDataFrame([("t0", "m", "a", False, 1), ("t0", "m", "b", False, 2), ("t3", "m", None, True, 3), ("zz", "odd", "c", False, 4)], "tok string, model string, summary string, unclear boolean, seq int")
    assert rows_of(documents.summarised(rows, places, s, ["m"])) == [(1, "b", "m", 0), (2, "b", "m", None)]
    with pytest.raises(Exception, match="unknown model"):
        documents.summarised(rows, places, s.withColumn("model", F.lit("odd")), ["m"]).collect()


def test_vendor_clusters_and_groups(spark):
    rows = spark.createDataFrame([("Acme Inc", 5.0), ("ACME", 7.0), ("ACME", 1.0), ("Solo", 9.0), ("", 3.0)], "vendor string, amount_value double")
    spent = vendors.spend(rows)
    assert rows_of(spent) == [("ACME", 8.0, 2), ("Acme Inc", 5.0, 1), ("Solo", 9.0, 1)]
    found = vendors.clusters(spent)
    assert rows_of(found) == [("ACME", 2, 13.0, ["ACME", "Acme Inc"])]
    both = spark.createDataFrame([("ACME",), ("Acme Inc",)], "spelling string")
    assert vendors.clusters(spent, both).count() == 0
    groups = spark.createDataFrame([("Acme", "ACME"), ("Gone", "GONE CO")], "canonical string, spelling string")
    assert rows_of(vendors.grouped(rows, groups), "vendor", "vendor_group")[1] == ("ACME", "Acme")
    assert rows_of(vendors.stale_spellings(rows, groups)) == [("GONE CO", "Gone")]


def test_differences(spark):
    a, b = spark.createDataFrame([("x", 1), ("y", 2)], "key string, value int"), spark.createDataFrame([("y", 3), ("z", 4)], "key string, value int")
    assert rows_of(diff.keys_diff(a, b, ["key"])) == [("x", "vanished"), ("y", "kept"), ("z", "new")]
    assert rows_of(diff.mapping_drift(a, b), "key", "change") == [("x", "removed"), ("y", "changed"), ("z", "added")]
    assert rows_of(diff.field_changes(a, b, "key", ["value"])) == [("y", "value", "2", "3")]
    assert diff.implausible(spark.range(10), spark.range(4)) and not diff.implausible(spark.range(10), spark.range(5))


def test_patched_snapshot(spark):
    rows = frame(spark, [record(1), record(2, detail_url="u2", status="Expired"), record(3, detail_url="u2", status="Expired", amount="$3.00"), record(4, detail_url="u3"), record(5, detail_url="u3")])
    urls = lambda *u: spark.createDataFrame([(x,) for x in u], "detail_url string")
    amended = spark.createDataFrame([("u3", "amount", "$9.00"), ("u3", "vendor", None)], "detail_url string, field string, to string")
    got = rows_of(diff.patched(rows, urls("u1"), urls("u2"), amended), "seq", "status", "amount")
    assert got == [(1, "Expired", "$1.00"), (2, "Expired", "$1.00"), (3, "Active", "$3.00"), (4, "Active", "$9.00")]
    assert diff.patched(rows, urls("u1"), urls("u2"), amended).where("vendor is null").select("detail_url").distinct().collect()[0][0] == "u3"


@pytest.mark.parametrize(("known", "vanished", "seen", "want"), [(5, 5, 0, "nothing seen"), (4, 4, 0, None), (20, 11, 9, "more than half vanished"), (20, 10, 10, None), (19, 18, 1, None)])
def test_refusal(spark, known, vanished, seen, want):
    assert spark.range(1).select(guards.refusal(F.lit(known), F.lit(vanished), F.lit(seen))).first()[0] == want


def test_breaker_and_leak(spark):
    flag = lambda c: spark.range(1).select(c).first()[0]
    assert [flag(guards.breaker(F.lit(k), F.lit(v))) for k, v in ((50, 26), (50, 25), (49, 49))] == [True, False, False]
    assert [flag(guards.leak(F.lit(s), F.lit(n))) for s, n in ((5, 99), (5, 100), (4, 10))] == [True, False, False]


def test_streaks_count_a_night_once_and_reset(spark):
    d = lambda n: dt.date(2026, 1, n)
    nights = spark.createDataFrame([("e", d(1), True), ("e", d(2), False), ("e", d(3), True), ("e", d(3), True), ("e", d(4), True), ("f", d(4), False), ("f", d(5), False)], "entity string, night date, leaked boolean")
    found = guards.streaks(nights)
    assert rows_of(found) == [("e", 2, d(4))]
    assert guards.persistent(found).count() == 0


def test_ledger_sweep_and_limits(spark):
    ledger = spark.createDataFrame([("a", "2025-01-01"), ("b", "2026-01-01"), ("c", "no date")], "k string, seen string")
    assert rows_of(guards.live_ledger(ledger, F.lit("2026-06-01").cast("date")), "k") == [("b",), ("c",)]
    pages = spark.createDataFrame([("e", 1, dt.date(2026, 6, 1)), ("e", 2, dt.date(2026, 5, 1)), ("e", 2, dt.date(2026, 1, 1)), ("e", 3, dt.date(2025, 1, 1)), ("e", 4, dt.date(2026, 6, 1))], "entity string, page int, begin date")
    assert rows_of(guards.whole_pages(pages, F.lit("2026-06-05").cast("date")), "page") == [(1,), (2,), (2,)]
    with pytest.raises(ValueError, match="unaccounted"):
        guards.unfinished(spark.range(1500), spark.range(0), "id")
    assert guards.unfinished(spark.range(10), spark.range(8), "id").count() == 8


def test_service_freshness_and_stamps(spark):
    checks = lambda *x: guards.service_healthy(spark.createDataFrame(list(x), "clean boolean, files int")).first()[0]
    assert checks((True, 0), (False, 0)) is False and checks((False, 0)) is True and checks((True, 0), (True, 2)) is True
    stamps = spark.createDataFrame([("a", dt.datetime(2026, 1, 2)), ("b", dt.datetime(2026, 1, 1))], "dataset string, at timestamp")
    assert guards.freshness(stamps, 2).first()[0] == dt.datetime(2026, 1, 1)
    assert guards.freshness(stamps, 3).first()[0] is None
    assert rows_of(guards.stale_stamps(stamps, F.lit("2026-01-01 12:00:00").cast("timestamp")), "dataset", "reason") == [("b", "stale")]


def test_record_rules(spark):
    rows = frame(spark, [record(1), record(2, entity_name="Nobody"), record(3, doc_number="a-1"), record(4, detail_url=""), record(5, doc_number="A" * 256)])
    got = rows_of(guards.quarantined(rows, guards.record_rules(["Roads"])), "seq", "reason")
    assert got == [(2, "unknown entity"), (3, "lower-case document number"), (4, "no detail URL"), (5, "long document number")]


def test_reports(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 5), ("a", 9), ("a", 7), ("b", 3)], "g string, n int")
    assert rows_of(reports.extraction(rows, "g", "n")) == [("a", 4, 7, 9), ("b", 1, 3, 3)]
    log = spark.createDataFrame([("x", "t"), ("y", "")], "tok string, text string")
    assert rows_of(reports.regression(log, log)) == []
    assert rows_of(reports.regression(log, log.where("tok = 'y'"))) == [("fewer records", 1), ("texts lost", 1), ("tokens lost", 1)]
    ocr = spark.createDataFrame([({"v": {"seconds_per_page": 2.0, "described": True, "error": None}},), ({"v": {"seconds_per_page": 0.0, "described": False, "error": "e"}},)], "engines map<string,struct<seconds_per_page:double,described:boolean,error:string>>")
    assert rows_of(reports.engines(ocr)) == [("v", 2, 50.0, 2.0, 1)]
    assert rows_of(index.word_stats(index.postings(spark.createDataFrame([(1, "The the cat"), (2, "cat")], "row_id int, d string"), "d"))) == [("cat", 2, 1, 2), ("the", 1, 1, 1)]


def test_unaccounted_rows_without_limit(spark, tmp_path):
    from ledgerline.plans.queries import QUERIES

    assert guards.unfinished(spark.range(1500), spark.range(200), "id", limit=None).count() == 200
    spark.range(50_000).withColumnRenamed("id", "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    kept = QUERIES["ST13_accounted_rows"](spark, str(tmp_path))
    assert kept.count() == 48_750 and kept.where("doc_id % 40 = 3").isEmpty()
    with pytest.raises(ValueError, match="unaccounted"):
        guards.unfinished(spark.range(1500), spark.range(200), "id")


def test_many_summaries_of_a_shared_document(spark):
    # 5,000 summaries of a document of 100,000 rows: only the latest meets the rows. An older one of an unknown model still fails.
    rows = spark.range(100_000).select(F.col("id").alias("row_id"), F.lit("t0").alias("view_token"))
    places = rows.where("row_id % 2 = 0").select(F.lit("t0").alias("token"), "row_id", F.lit(3).alias("position"))
    s = spark.range(5000).select(F.lit("t0").alias("tok"), F.lit("m").alias("model"), F.concat(F.lit("about "), "id").alias("summary"), F.lit(False).alias("unclear"), F.col("id").alias("seq"))
    began = time.monotonic()
    got = documents.summarised(rows, places, s, ["m"]).groupBy("summary", "model", "position").count().collect()
    assert sorted(map(tuple, got), key=str) == [("about 4999", "m", 3, 50_000), ("about 4999", "m", None, 50_000)]
    assert time.monotonic() - began < 60
    odd = s.withColumn("model", F.when(F.col("seq") == 7, None).otherwise("m"))
    with pytest.raises(Exception, match="unknown model: none"):
        documents.summarised(rows.limit(3), places.limit(3), odd, ["m"]).collect()
