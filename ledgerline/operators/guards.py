"""Guard rails of a nightly difference. Each gives a reason or a flag; none repairs anything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALL_GONE_FLOOR, SHARE_FLOOR, DATASET_FLOOR, STRAY_FLOOR, REPORT_FLOOR = 5, 20, 50, 5, 5
LEAK_NIGHTS, SWEEP_DAYS, LEDGER_DAYS, FAILURE_RUN, AMEND_LIMIT, STRAY_SAMPLE, UNFINISHED_LIMIT = 3, 35, 365, 25, 2000, 5, 1000


def refusal(known: Column, vanished: Column, seen: Column) -> Column:
    """Why an entity's flips are refused; null if they aren't."""
    return F.when((known >= ALL_GONE_FLOOR) & (seen == 0), "nothing seen").when((known >= SHARE_FLOOR) & (vanished * 2 > known), "more than half vanished")


def breaker(known: Column, vanished: Column) -> Column:
    """Nothing of a dataset flips."""
    return (known >= DATASET_FLOOR) & (vanished * 2 > known)


def leak(strays: Column, listed: Column) -> Column:
    return (strays >= STRAY_FLOOR) & (strays * 20 > listed)


def verdicts(per_entity: DataFrame) -> DataFrame:
    """dataset, entity, known, seen, vanished, strays, listed with refusal, leak and the dataset's breaker."""
    w = Window.partitionBy("dataset")
    c = F.col
    return per_entity.withColumns(
        {
            "refusal": refusal(c("known"), c("vanished"), c("seen")),
            "leak": leak(c("strays"), c("listed")),
            "breaker": breaker(F.sum("known").over(w), F.sum("vanished").over(w)),
            "dataset_leak": leak(F.sum("strays").over(w), F.sum("listed").over(w)),
        }
    )


def suspicious(report: DataFrame) -> DataFrame:
    """Entities of a diff report of which more than half flipped. report: dataset, entity, previously_active, flipped."""
    return report.where((F.col("previously_active") >= REPORT_FLOOR) & (F.col("flipped") * 2 > F.col("previously_active")))


def service_healthy(checks: DataFrame) -> DataFrame:
    """Unhealthy only if there was a clean read and none offered a file. checks: clean, files."""
    return checks.agg((~((F.count_if("clean") > 0) & (F.count_if((F.col("clean")) & (F.col("files") > 0)) == 0))).alias("healthy"))


def freshness(stamps: DataFrame, datasets: int) -> DataFrame:
    """The oldest stamp; null if a dataset lacks one. stamps: dataset, at (null if it can't be read)."""
    return stamps.agg(F.when((F.count_distinct(F.when(F.col("at").isNotNull(), F.col("dataset"))) == datasets) & (F.count_if(F.col("at").isNull()) == 0), F.min("at")).alias("at"))


def stale_stamps(stamps: DataFrame, night_start: Column) -> DataFrame:
    """Datasets without a stamp since the night began, with the reason."""
    reason = F.when(F.col("at").isNull(), "unreadable").when(F.col("at") < night_start, "stale")
    return stamps.withColumn("reason", reason).where("reason is not null")


def deployed(built: Column, dispatched: Column) -> Column:
    """A live build counts if it isn't older than two minutes before the dispatch."""
    return built >= dispatched - F.expr("INTERVAL 2 MINUTES")


def unfinished(rows: DataFrame, accounted: DataFrame, key: str, limit: int | None = UNFINISHED_LIMIT) -> DataFrame:
    """Rows that are accounted for; refuses to drop more than the limit. None: drops however many there are."""
    if limit is not None and rows.join(accounted.select(key).distinct(), key, "left_anti").limit(limit + 1).count() > limit:
        raise ValueError(f"more than {limit} rows are unaccounted for")
    return rows.join(accounted.select(key).distinct(), key, "left_semi")


def live_ledger(ledger: DataFrame, today: Column) -> DataFrame:
    """The flip ledger without entries older than a year; what has no readable date stays."""
    return ledger.where(F.col("seen").try_cast("date").isNull() | (F.date_diff(today, F.col("seen").try_cast("date")) <= LEDGER_DAYS))


def streaks(nights: DataFrame, entity: str = "entity", night: str = "night", leaked: str = "leaked") -> DataFrame:
    """Of each entity the current run of leaking nights; a night counts once, a clean one ends the run."""
    once = nights.groupBy(entity, night).agg(F.bool_or(leaked).alias(leaked))
    clean = once.where(~F.col(leaked)).groupBy(entity).agg(F.max(night).alias("_clean"))
    run = once.where(leaked).join(clean, entity, "left").where(F.col("_clean").isNull() | (F.col(night) > F.col("_clean")))
    return run.groupBy(entity).agg(F.count("*").alias("nights"), F.max(night).alias("last"))


def judged_and_cleared(report: DataFrame, write, verdict) -> bool:
    """`verdict` of a report, which is empty afterwards, pass or fail. write: replaces the report's table."""
    try:
        return verdict(report)
    finally:
        write(report.limit(0))


def persistent(found: DataFrame) -> DataFrame:
    return found.where(F.col("nights") >= LEAK_NIGHTS)


def late(events: DataFrame, held: DataFrame, key: str, day: str, as_of: Column, days: int = SWEEP_DAYS) -> DataFrame:
    """Rows of the last days that aren't held yet."""
    return events.where(F.col(day) >= F.date_sub(as_of, days)).join(held.select(key).distinct(), key, "left_anti")


def whole_pages(listed: DataFrame, as_of: Column, days: int = SWEEP_DAYS) -> DataFrame:
    """Newest-first pages up to the first that is wholly before the window; pages are kept whole. listed: entity, page, begin."""
    since = F.date_sub(as_of, days)
    per = listed.groupBy("entity", "page").agg(F.max("begin").alias("newest"))
    stop = per.where(F.col("newest") < since).groupBy("entity").agg(F.min("page").alias("stop"))
    return listed.join(stop, "entity", "left").where(F.col("stop").isNull() | (F.col("page") < F.col("stop"))).drop("stop")


def work_list(changes: DataFrame, seq: str = "seq", limit: int = AMEND_LIMIT) -> DataFrame:
    """The night's work: the first entries up to the limit (the feature: the rest waits for the next night)."""
    return changes.orderBy(seq).limit(limit)


def stray_sample(strays: DataFrame, n: int = STRAY_SAMPLE) -> DataFrame:
    """Up to five stray ids per entity, in order: n minima by repeated aggregation keep the state small."""
    return strays.groupBy("entity").agg(F.slice(F.array_sort(F.collect_set("id")), 1, n).alias("sample"), F.count_distinct("id").alias("strays"))


def quarantined(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with the first reason: a build aborts if there are any."""
    reason = F.coalesce(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules.items()])
    return rows.withColumn("reason", reason).where("reason is not null")


def record_rules(entities: list[str]) -> dict[str, Column]:
    """What no published row may be."""
    c = F.col
    return {
        "unknown entity": ~c("entity_name").isin(entities),
        "no detail URL": c("detail_url") == "",
        "no document number": c("doc_number") == "",
        "long document number": F.octet_length("doc_number") > 255,
        "lower-case document number": c("doc_number") != F.upper("doc_number"),
    }


def too_many_odd(rows: DataFrame, odd: Column, share: float = 0.001) -> DataFrame:
    """odd, total, abort: a few odd tokens travel as exceptions, more than the share abort."""
    return rows.agg(F.count_if(odd).alias("odd"), F.count("*").alias("total")).withColumn("abort", F.col("odd") > F.col("total") * share)
