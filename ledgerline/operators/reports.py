"""Reports on coverage, extraction and quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upper_median(values: Column) -> Column:
    """The middle value of a collected list; of two the larger one."""
    return F.element_at(F.sort_array(values), (F.size(values) / 2).cast("int") + 1)


def extraction(rows: DataFrame, group: str, size: str) -> DataFrame:
    """group, n, median (upper), longest. Sizes are counted first, so a group's state is its distinct sizes."""
    counts = rows.groupBy(group, size).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(group).orderBy(size)
    run = counts.withColumn("upto", F.sum("_n").over(w)).withColumn("total", F.sum("_n").over(Window.partitionBy(group)))
    middle = F.floor(F.col("total") / 2) + 1
    return run.groupBy(group).agg(F.max("total").alias("n"), F.min(F.when(F.col("upto") >= middle, F.col(size))).alias("median"), F.max(size).alias("longest"))


def shares(rows: DataFrame, group: list[str], part: str) -> DataFrame:
    """group, part, n, share of the group in percent."""
    counts = rows.groupBy(*group, part).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy(*group)), 4))


def engines(ocr: DataFrame) -> DataFrame:
    """engine, documents, described_pct, seconds_per_page (mean of non-zero ones), failed. ocr: engines map."""
    each = ocr.select(F.explode("engines").alias("engine", "r"))
    per_page = F.when(F.col("r.seconds_per_page") > 0, F.col("r.seconds_per_page"))
    return each.groupBy("engine").agg(
        F.count("*").alias("documents"), F.round(100 * F.count_if("r.described") / F.count("*"), 4).alias("described_pct"), F.round(F.avg(per_page), 6).alias("seconds_per_page"), F.count_if(F.col("r.error").isNotNull()).alias("failed")
    )


def projected_hours(report: DataFrame, pages: int) -> DataFrame:
    return report.withColumn("hours", F.round(F.col("seconds_per_page") * pages / 3600, 4))


def scan_totals(log: DataFrame) -> DataFrame:
    """records, tokens, tokens_with_text of a release."""
    return log.agg(F.count("*").alias("records"), F.count_distinct("tok").alias("tokens"), F.count_distinct(F.when(F.coalesce(F.trim("text"), F.lit("")) != "", F.col("tok"))).alias("tokens_with_text"))


def regression(old: DataFrame, new: DataFrame) -> DataFrame:
    """reason, n: tokens lost, texts lost, fewer records; no row if a release may be published. (tok, text) both."""
    text = lambda t: t.where("coalesce(trim(text), '') <> ''").select("tok").distinct()
    lost = old.select("tok").distinct().join(new.select("tok").distinct(), "tok", "left_anti").agg(F.count("*").alias("n")).select(F.lit("tokens lost").alias("reason"), "n")
    silent = text(old).join(text(new), "tok", "left_anti").agg(F.count("*").alias("n")).select(F.lit("texts lost").alias("reason"), "n")
    size = old.select(F.lit(1).alias("s")).unionByName(new.select(F.lit(-1).alias("s"))).agg(F.coalesce(F.sum("s"), F.lit(0)).alias("n")).select(F.lit("fewer records").alias("reason"), "n")
    return lost.union(silent).union(size).where("n > 0")


def diff_totals(report: DataFrame, counts: list[str]) -> DataFrame:
    """Sums per dataset and night; of an entity's repeated counts the first (by seq) count."""
    first = report.groupBy("dataset", "night", "entity").agg(F.min_by(F.struct(*counts), "seq").alias("c")).select("dataset", "night", "c.*")
    return first.groupBy("dataset", "night").agg(*[F.sum(c).alias(c) for c in counts])


def alphabet(rows: DataFrame, column: str) -> DataFrame:
    """The distinct characters of a column in order, as one string."""
    chars = rows.select(F.explode(F.array_distinct(F.split(column, ""))).alias("c")).where("c <> ''").distinct()
    return chars.agg(F.array_join(F.array_sort(F.collect_list("c")), "").alias("alphabet"))


def one_to_one(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with several values: must be empty."""
    return rows.groupBy(key).agg(F.count_distinct(value).alias("values")).where("values > 1")


def median_since(rows: DataFrame, value: str, at: str, since: Column) -> DataFrame:
    return rows.where(F.col(at) > since).agg(F.median(value).alias("median"))


def age_days(at: Column, now: Column, warn: int) -> dict[str, Column]:
    days = F.date_diff(now, at)
    return {"age_days": days, "warn": days > warn}


def sample_per_group(rows: DataFrame, group: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows of each group in the order of a seeded hash: the same ones on every run, and in every engine."""
    order = _drawn(key, seed)
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(order, key))).where(F.col("_n") <= n).drop("_n")


def sample(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows of all in the order of a seeded hash."""
    return rows.orderBy(_drawn(key, seed), key).limit(n)


def _drawn(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def mix(rows: DataFrame, dims: list[str], amount: str) -> DataFrame:
    """Totals by all of `dims`, by each front part of them, and over all (null dimensions)."""
    return rows.rollup(*dims).agg(F.count("*").alias("n"), F.sum(F.col(amount).cast("decimal(18,2)")).cast("double").alias("total"))
