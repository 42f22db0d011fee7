"""Differences between snapshots: what is new, gone or changed, and how a new snapshot follows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keys_diff(known: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """keys and change: kept, new or vanished."""
    a, b = known.select(*keys).distinct().withColumn("_k", F.lit(True)), seen.select(*keys).distinct().withColumn("_s", F.lit(True))
    change = F.when(F.col("_k").isNull(), "new").when(F.col("_s").isNull(), "vanished").otherwise("kept")
    return a.join(b, keys, "full_outer").select(*keys, change.alias("change"))


def field_changes(base: DataFrame, fresh: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, field, from, to: one row per watched field that differs."""
    before, after = base.select(key, *[F.col(f).alias(f"_b_{f}") for f in fields]), fresh.select(key, *[F.col(f).alias(f"_a_{f}") for f in fields])
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_b_{f}").cast("string").alias("from"), F.col(f"_a_{f}").cast("string").alias("to")) for f in fields])
    return before.join(after, key).select(key, F.explode(F.filter(each, lambda x: ~x["from"].eqNullSafe(x["to"]))).alias("c")).select(key, "c.field", "c.from", "c.to")


def mapping_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """key, change (added, removed, changed), old_value, new_value of two (key, value) maps."""
    a, b = old.select("key", F.col("value").alias("old_value"), F.lit(True).alias("_a")), new.select("key", F.col("value").alias("new_value"), F.lit(True).alias("_b"))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("changed")
    return a.join(b, "key", "full_outer").where("_a is null or _b is null or not (old_value <=> new_value)").select("key", change.alias("change"), "old_value", "new_value")


def implausible(old: DataFrame, new: DataFrame) -> Column | bool:
    """A new listing of less than half the old one is a failure, not drift."""
    return new.count() * 2 < old.count()


def expired_only(records: DataFrame, url: str = "detail_url") -> DataFrame:
    """URLs that have Expired rows and no Active one."""
    return records.where("status = 'Expired'").select(url).exceptAll(records.where("status = 'Active'").select(url)).distinct().join(records.where("status = 'Active'").select(url).distinct(), url, "left_anti")


def coverage_gap(entities: DataFrame, statuses: list[str], done: DataFrame) -> DataFrame:
    """(entity, status) pairs that aren't done. Both sides are small dimensions."""
    pairs = entities.select("entity", F.explode(F.array(*map(F.lit, statuses))).alias("status"))
    return pairs.join(done.select("entity", "status"), ["entity", "status"], "left_anti")


def patched(records: DataFrame, flips: DataFrame, restored: DataFrame, amended: DataFrame, url: str = "detail_url", seq: str = "seq") -> DataFrame:
    """The next snapshot in one pass: Active rows in `flips` expire, the last Expired row in `restored` is Active again, and
    Active rows take the values of `amended` (url, field, to: a row per changed field, null included); all else a row keeps
    from itself. Whole repeated rows are kept once, the first."""
    f, r = flips.select(url).distinct().withColumn("_f", F.lit(True)), restored.select(url).distinct().withColumn("_r", F.lit(True))
    # The place of each URL's last Expired row, for those that come back.
    last = records.where("status = 'Expired'").join(r, url, "left_semi").groupBy(url).agg(F.max(seq).alias("_last"))
    # A URL has a few changed fields at most: one map.
    a = amended.groupBy(url).agg(F.map_from_entries(F.collect_list(F.struct("field", "to"))).alias("_new"))
    joined = records.join(f, url, "left").join(last, url, "left").join(a, url, "left")
    status = F.when((F.col("status") == "Active") & F.col("_f"), "Expired").when((F.col("status") == "Expired") & (F.col(seq) == F.col("_last")), "Active").otherwise(F.col("status"))
    kinds = {x.name: x.dataType for x in records.schema.fields}
    changed = lambda c: (F.col("status") == "Active") & F.coalesce(F.map_contains_key("_new", F.lit(c)), F.lit(False))
    taken = lambda c: F.when(changed(c), F.element_at("_new", F.lit(c)).cast(kinds[c])).otherwise(F.col(c)).alias(c)
    out = joined.select(*[status.alias("status") if c == "status" else F.col(c) if c in (url, seq) else taken(c) for c in records.columns])
    rest = [c for c in records.columns if c != seq]
    return out.groupBy(*rest).agg(F.min(seq).alias(seq)).select(*records.columns)


def set_sizes(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """op, n: how many keys the union, the intersection and the difference a - b have."""
    change = F.col("change")
    sizes = keys_diff(a, b, [key]).agg(F.count("*").alias("union"), F.count_if(change == "kept").alias("intersect"), F.count_if(change == "vanished").alias("except"))
    return sizes.select(F.explode(F.array(*[F.struct(F.lit(c).alias("op"), F.col(f"`{c}`").alias("n")) for c in ("union", "intersect", "except")])).alias("x")).select("x.*")


def union_of(parts: list[DataFrame], key: str) -> DataFrame:
    """All keys of several tables, each once, in order."""
    return reduce(DataFrame.unionByName, [p.select(key) for p in parts]).distinct().orderBy(key)


def lost(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys that a new release lacks."""
    return old.select(key).distinct().join(new.select(key).distinct(), key, "left_anti")


def all_of(*parts: Column) -> Column:
    return reduce(lambda a, b: a & b, parts)
