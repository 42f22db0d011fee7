"""Vendors: spend, proposed clusters of spellings, reviewed groups, shards. Nothing is merged unless it was reviewed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import shard_letter, vendor_key


def spend(rows: DataFrame, vendor: str = "vendor", amount: str = "amount_value") -> DataFrame:
    """vendor, total, n; blank vendors are left out."""
    return rows.where(F.trim(vendor) != "").groupBy(F.col(vendor).alias("vendor")).agg(F.sum(F.col(amount).cast("decimal(18,2)")).cast("double").alias("total"), F.count("*").alias("n"))


def clusters(spent: DataFrame, reviewed: DataFrame | None = None) -> DataFrame:
    """Keys with two spellings and more, not all of them reviewed: members by spend, largest total first.

    spent: vendor, total, n. reviewed: spelling. An empty key is no cluster. Rows are one per spelling, so a group holds the
    spellings of one firm.
    """
    keyed = spent.withColumn("key", vendor_key(F.col("vendor"))).where("key <> ''")
    if reviewed is not None:
        known = reviewed.select(F.col("spelling").alias("vendor")).distinct().withColumn("known", F.lit(True))
        keyed = keyed.join(known, "vendor", "left")
    else:
        keyed = keyed.withColumn("known", F.lit(None).cast("boolean"))
    member = F.struct((-F.col("total")).alias("order"), "vendor", "total", "n")
    found = keyed.groupBy("key").agg(F.count("*").alias("spellings"), F.sum(F.col("total").cast("decimal(38,2)")).cast("double").alias("total"), F.bool_and(F.coalesce("known", F.lit(False))).alias("all_known"), F.sort_array(F.collect_list(member)).alias("m"))
    return found.where("spellings >= 2 and not all_known").select("key", "spellings", "total", F.transform("m", lambda x: x["vendor"]).alias("members")).orderBy(F.desc("total"), F.desc("key"))


def at_stake(found: DataFrame) -> DataFrame:
    return found.agg(F.round(F.coalesce(F.sum("total"), F.lit(0.0)), 2).alias("at_stake"), F.count("*").alias("clusters"))


def grouped(rows: DataFrame, groups: DataFrame, vendor: str = "vendor") -> DataFrame:
    """`rows` with `vendor_group`: the reviewed canonical name, else the vendor itself. groups: canonical, spelling."""
    names = groups.select(F.col("spelling").alias(vendor), "canonical")
    return rows.join(names, vendor, "left").withColumn("vendor_group", F.coalesce("canonical", vendor)).drop("canonical")


def stale_spellings(rows: DataFrame, groups: DataFrame, vendor: str = "vendor") -> DataFrame:
    """Reviewed spellings that no row has any more: a build aborts on them."""
    return groups.join(rows.select(F.col(vendor).alias("spelling")).distinct(), "spelling", "left_anti")


def shards(rows: DataFrame, columns: list[str], vendor: str = "vendor", order: str = "seq") -> DataFrame:
    """shard, vendor, then `columns`: all rows of each vendor together and in order, without removing duplicates.

    Rows are dealt by ranges of (shard, vendor, order), so a vendor with many rows is several tasks' and never one row.
    """
    named = rows.where(F.trim(vendor) != "").withColumn("_v", F.trim(vendor)).withColumn("_s", shard_letter(F.col("_v")))
    dealt = named.repartitionByRange("_s", "_v", order).sortWithinPartitions("_s", "_v", order)
    return dealt.select(F.col("_s").alias("shard"), F.col("_v").alias("vendor"), *columns)
