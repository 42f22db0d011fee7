"""Build and publish: raw records to a verified snapshot, as one declared plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import csv_guard, date_int, key_hash, money, query_param, view_suffix
from ..operators import dedup, guards
from ..operators.fold import numbered
from ..operators.index import postings
from ..sources.schemas import RECORD
from ..sources.snapshots import Store

VIEW_MARK = "ViewDocument?D="


def normalised(raw: DataFrame, type_groups: DataFrame | None = None) -> DataFrame:
    """Raw text rows with parsed columns beside them: amount_value, begin, end, k and the URL's parameters."""
    c = F.col
    out = raw.withColumns({"amount_value": money(c("amount")), "begin": date_int(c("begin_date")), "end": date_int(c("end_date")), "k": key_hash(c("detail_url"))})
    out = out.withColumns({f"p_{p.lower()}": query_param(c("detail_url"), p) for p in ("A", "D", "DN", "N", "DT", "V")})
    if type_groups is None:
        return out
    names = type_groups.select(F.col("key").alias("doc_type"), F.col("value").alias("_group"))
    return out.join(names, "doc_type", "left").withColumn("type_group", F.coalesce("_group", "doc_type")).drop("_group")


def published_rows(raw: DataFrame) -> DataFrame:
    """Without exact duplicates, twins and stale twins, in this order."""
    return dedup.without_stale(dedup.without_twins(dedup.exact(raw)))


def checked(rows: DataFrame, entities: list[str]) -> DataFrame:
    """Fails with the first reasons if any row breaks a rule."""
    bad = guards.quarantined(rows, guards.record_rules(entities)).select("reason", "doc_number").limit(5).collect()
    if bad:
        raise ValueError(f"rows that can't be published: {[(r.reason, r.doc_number) for r in bad]}")
    if not dedup.ambiguous(rows, ["doc_number", "entity_name", "doc_type"], "view_url").isEmpty():
        raise ValueError("several rows of one document number have no document")
    return rows


def with_view_token(rows: DataFrame, prefix: str) -> DataFrame:
    return rows.withColumn("view_token", view_suffix(F.col("view_url"), prefix))


def publish(rows: DataFrame, store: Store, descriptions: DataFrame | None = None) -> str:
    """Write records, index and descriptions (in their own table, joined at read), verify them from disk, swap the pointer."""
    spark = rows.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    build = store.new_build()
    ids = numbered(rows.drop("seq") if dict(rows.dtypes).get("seq", "").startswith("struct") else rows, ["detail_url", "doc_number", "status"])
    store.write(build, "records", ids, by=["dataset", "status"] if "dataset" in rows.columns else None)
    stored = store.read("records", build)
    if stored.count() != rows.count():
        raise ValueError("the written records differ in number")
    if descriptions is not None:
        store.write(build, "descriptions", descriptions)
        store.verify(build, "descriptions", descriptions)
        words = postings(stored.join(descriptions, "k"), "description")
        store.write(build, "index", words, sort=["word", "row_id"])
        store.verify(build, "index", words)
    store.publish(build)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    return build


def row_lists(rows: DataFrame, columns: list[str]) -> DataFrame:
    """row_id and the row as a JSON list of texts, the form that older readers take."""
    return rows.select("row_id", F.to_json(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])).alias("row"))


def as_csv(rows: DataFrame, as_of: str) -> DataFrame:
    """Raw columns for a spreadsheet: text cells guarded, the data's date last."""
    return rows.select(*[csv_guard(F.col(c)).alias(c) for c in RECORD.names], F.lit(as_of).alias("data_as_of"))
