"""Exact duplicates, twins and stale twins among records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import FINGERPRINT, TWIN
from .fold import first


def exact(records: DataFrame, seq: str = "seq", keys: list[str] | None = None) -> DataFrame:
    """Keep the first row of each fingerprint."""
    return first(records, keys or FINGERPRINT, seq)


def without_twins(records: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Drop Expired rows that equal an Active row in all but the status."""
    keys = keys or TWIN
    active = records.where("status = 'Active'").select(*keys).distinct()
    expired = records.where("status = 'Expired'").join(active, keys, "left_anti")
    return records.where("status <> 'Expired'").unionByName(expired)


def without_stale(records: DataFrame, url: str = "detail_url") -> DataFrame:
    """Drop Expired rows whose URL is Active; a blank URL matches nothing."""
    active = records.where((F.col("status") == "Active") & (F.col(url) != "")).select(url).distinct()
    expired = records.where("status = 'Expired'").join(active, url, "left_anti")
    return records.where("status <> 'Expired'").unionByName(expired.select(*records.columns))


def dropped(records: DataFrame, seq: str = "seq") -> DataFrame:
    """A row per reason with the number and sum of dropped rows (exact, twin, stale)."""
    one = exact(records, seq)
    two = without_twins(one)
    three = without_stale(two)
    out = None
    for reason, before, after in (("exact", records, one), ("twin", one, two), ("stale", two, three)):
        total = lambda t, sign: t.agg(F.count("*").alias("n"), F.sum("amount_value").alias("s")).select((F.col("n") * sign).alias("n"), (F.coalesce("s", F.lit(0.0)) * sign).alias("s"))
        row = total(before, 1).union(total(after, -1)).agg(F.sum("n").alias("rows"), F.round(F.sum("s"), 2).alias("dollars")).select(F.lit(reason).alias("reason"), "rows", "dollars")
        out = row if out is None else out.union(row)
    return out


def collisions(records: DataFrame, keys: list[str], destination: str) -> DataFrame:
    """Groups of one permalink with several destinations."""
    return records.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(destination).alias("destinations")).where("n > 1 and destinations > 1")


def ambiguous(records: DataFrame, keys: list[str], destination: str) -> DataFrame:
    """Groups with two rows and more that have no destination: these abort a build."""
    return records.groupBy(*keys).agg(F.count_if(F.col(destination) == "").alias("blank")).where("blank > 1")
