"""Streaming forms, driven to completion over files."""

import datetime as dt

from ledgerline.streaming import state


def stream(spark, tmp_path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return spark.readStream.schema(schema).parquet(f"{tmp_path}/in")


def drive(df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()
    return sorted(tuple(r) for r in df.sparkSession.table(name).collect())


def test_late_rows_once_per_key(spark, tmp_path):
    t = dt.datetime(2026, 1, 1)
    df = stream(spark, tmp_path, [("a", t), ("a", t), ("b", t)], "k string, at timestamp")
    assert [r[0] for r in drive(state.late_rows(df, ["k"], "at"), "late", "append")] == ["a", "b"]


def test_streak_state(spark, tmp_path):
    df = stream(spark, tmp_path, [("e", "2026-01-01", True), ("e", "2026-01-02", True), ("e", "2026-01-02", True), ("f", "2026-01-01", False)], "entity string, night string, leaked boolean")
    assert drive(state.streaks(df, "entity", "night", "leaked"), "streaks", "update") == [("e", 2, "2026-01-02"), ("f", 0, "2026-01-01")]


def test_upsert_batches(spark, tmp_path):
    df = stream(spark, tmp_path, [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, s int, v string")
    kept = {}
    step = state.upsert(lambda: None, lambda new, n: kept.__setitem__("rows", sorted(tuple(r) for r in new.collect())), ["k"], "s")
    q = df.writeStream.foreachBatch(step).start()
    q.processAllAvailable()
    q.stop()
    assert kept["rows"] == [("a", 2, "y"), ("b", 1, "z")]


def test_windowed_counts(spark, tmp_path):
    df = stream(spark, tmp_path, [("a", dt.datetime(2026, 1, 1, 0, 5)), ("a", dt.datetime(2026, 1, 1, 0, 50))], "g string, at timestamp")
    assert [r[2] for r in drive(state.windowed_counts(df, "at", "g"), "windows", "complete")] == [2]
