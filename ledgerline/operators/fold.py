"""Folds over keys with an order column: latest, first, best by rank, first-seen numbers, row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written


def latest(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The last row of each key by `seq`: one aggregation with map-side combine, no sort of whole groups."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def first(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The first row of each key by `seq`."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(seq)).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def best_by_rank(df: DataFrame, keys: list[str], rank: str, seq: str) -> DataFrame:
    """The row of the least rank per key; of equal ranks the later one."""
    rest = [c for c in df.columns if c not in keys]
    order = F.struct((-F.col(rank)).alias("r"), F.col(seq).alias("s"))
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def first_seen_index(df: DataFrame, value: str, seq: str) -> DataFrame:
    """value and its number from 0 by first appearance. Numbered by ranges, so a large dictionary isn't one task's."""
    seen = df.groupBy(value).agg(F.min(seq).alias("first_seq"))
    return numbered(seen, ["first_seq"], "idx").select(value, "first_seq", "idx")


def numbered(df: DataFrame, order: list[Column | str], name: str = "row_id") -> DataFrame:
    """Row numbers from 0 in an order, without sending all rows to one task: ranges are counted, then offset.

    Ranges are chosen by a sample that differs from run to run, so they are written before they are counted.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id() - F.shiftleft(F.col("_p").cast("long"), 33))
    ranged = written(ranged, "numbered")
    counts = {r["_p"]: r["n"] for r in ranged.groupBy("_p").agg(F.count("*").alias("n")).collect()}
    start, offsets = 0, []
    for p in sorted(counts):
        offsets.append((p, start))
        start += counts[p]
    if not offsets:
        return df.withColumn(name, F.lit(0).cast("long"))
    table = F.create_map(*[F.lit(x) for pair in offsets for x in pair])
    return ranged.withColumn(name, (F.col("_i") + F.element_at(table, F.col("_p"))).cast("long")).drop("_p", "_i")


def first_of_list(df: DataFrame, key: str, values: str, name: str = "value") -> DataFrame:
    """key, position, value of a list's distinct elements, each where it stands first. Lists are taken apart, not compared."""
    each = df.select(key, F.posexplode(values).alias("position", name))
    return each.groupBy(key, name).agg(F.min("position").alias("position")).select(key, "position", name)


def running_violations(df: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """Rows of a newest-first list whose value is above the least one before them in their group (a group is sorted in one task)."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("floor", F.min(value).over(w)).where(F.col(value) > F.col("floor"))


def islands(df: DataFrame, group: list[str], order: list[str], hit: Column) -> DataFrame:
    """Runs of consecutive hits per group: group columns, run_start, run_end (of the first order column), length."""
    w = Window.partitionBy(*group).orderBy(*order)
    marked = df.withColumn("_hit", hit).withColumn("_run", F.sum(F.when(F.col("_hit"), 0).otherwise(1)).over(w))
    return marked.where("_hit").groupBy(*group, "_run").agg(F.min(order[0]).alias("run_start"), F.max(order[0]).alias("run_end"), F.count("*").alias("length")).drop("_run")
