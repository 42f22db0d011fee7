"""The nightly difference: classify, judge, then write in an order that survives an interruption."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import diff, guards
from ..sources.schemas import WATCHED


def since(text: str, today: date) -> date:
    """A number is that many days back, anything else an ISO date."""
    return today - timedelta(days=int(text)) if text.isdigit() else date.fromisoformat(text)


@dataclass
class Night:
    """What a night found, after judgement."""

    flips: DataFrame
    restored: DataFrame
    new_rows: DataFrame
    held_back: DataFrame
    changes: DataFrame
    verdicts: DataFrame
    report: DataFrame


def judged(records: DataFrame, seen: DataFrame, ledger: DataFrame, read: DataFrame | None = None) -> Night:
    """records: the current snapshot. seen: tonight's rows of all entities read, with dataset and entity_name. read: the
    (dataset, entity_name) pairs that were read, also those that listed nothing; without it, those that listed something.

    Order of judgement: leaks first, then refusals, then the dataset's breaker. A refused entity keeps its new rows but no
    flips; a leak holds back new rows and restorations; a breaker clears flips, restorations and changes, not new rows.
    """
    key = ["dataset", "entity_name", "detail_url"]
    active = records.where("status = 'Active'")
    read = (seen if read is None else read).select("dataset", "entity_name").distinct()
    known = active.join(read, ["dataset", "entity_name"], "left_semi")
    moved = diff.keys_diff(known, seen, key)
    gone = diff.expired_only(records).withColumn("_old", F.lit(True))
    noted = ledger.select(F.col("detail_url")).distinct().withColumn("_ours", F.lit(True))
    marked = moved.join(gone, "detail_url", "left").join(noted, "detail_url", "left")
    # What we expired ourselves comes back; what was expired before us and is listed again is a stray of another list.
    kind = F.when((F.col("change") == "new") & F.col("_old") & F.col("_ours"), "restored").when((F.col("change") == "new") & F.col("_old"), "stray").otherwise(F.col("change"))
    marked = marked.withColumn("kind", kind).drop("_old", "_ours")
    count = lambda k: F.count_if(F.col("kind") == k)
    per = marked.groupBy("dataset", "entity_name").agg(
        (count("kept") + count("vanished")).alias("known"), (count("kept") + count("new") + count("restored") + count("stray")).alias("seen"), count("vanished").alias("vanished"),
        count("stray").alias("strays"), (count("kept") + count("new") + count("restored") + count("stray")).alias("listed"), count("kept").alias("still_active"), count("new").alias("newly_active"), count("restored").alias("flipped_back"),
    )
    verdicts = guards.verdicts(per.withColumnRenamed("entity_name", "entity")).withColumnRenamed("entity", "entity_name")
    flags = verdicts.select("dataset", "entity_name", "refusal", F.coalesce("breaker", F.lit(False)).alias("breaker"), (F.coalesce("leak", F.lit(False)) | F.coalesce("dataset_leak", F.lit(False))).alias("leaky"))
    full = marked.join(flags, ["dataset", "entity_name"])
    flips = full.where("kind = 'vanished' and refusal is null and not breaker")
    restored = full.where("kind = 'restored' and not leaky and not breaker")
    fresh = seen.join(full.where("kind = 'new' and not leaky").select(*key), key, "left_semi")
    held = seen.join(full.where("kind = 'new' and leaky").select(*key), key, "left_semi")
    kept = full.where("kind = 'kept' and not breaker").select("detail_url")
    changes = diff.field_changes(active.join(kept, "detail_url", "left_semi"), seen.join(kept, "detail_url", "left_semi"), "detail_url", WATCHED)
    flipped = full.groupBy("dataset", "entity_name").agg(F.count_if((F.col("kind") == "vanished") & F.col("refusal").isNull() & ~F.col("breaker")).alias("flipped_to_expired"), F.count_if((F.col("kind") == "new") & F.col("leaky")).alias("held_back"))
    report = per.select("dataset", "entity_name", F.col("known").alias("previously_active"), "still_active", "newly_active", "flipped_back").join(flipped, ["dataset", "entity_name"])
    return Night(flips.select(*key), restored.select(*key), fresh, held, changes, verdicts, report)


def next_snapshot(records: DataFrame, night: Night) -> DataFrame:
    """The records after the night: flips, restorations and amendments in one rewrite, then the new rows."""
    patched = diff.patched(records, night.flips, night.restored, night.changes.select("detail_url", "field", "to").distinct())
    return patched.unionByName(night.new_rows.withColumn("status", F.lit("Active")).select(*[c for c in records.columns]))
