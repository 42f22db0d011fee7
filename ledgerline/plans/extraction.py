"""Text log to descriptions, with a report per source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parsers import described
from ..operators.reports import extraction


def scope(text_log: DataFrame, chain: list | None = None) -> DataFrame:
    """tok, doc, source, description, items of every readable document that some parser describes."""
    readable = text_log.where("data.status = 'text'").select("tok", F.col("data.doc").alias("doc"), F.col("data.text").alias("text"))
    return described(readable, "text", chain).where("source is not null").drop("text")


def report(scoped: DataFrame) -> DataFrame:
    return extraction(scoped.withColumn("size", F.length("description")), "source", "size")


def status_tally(text_log: DataFrame) -> DataFrame:
    return text_log.groupBy(F.col("data.status").alias("status")).agg(F.count("*").alias("n"))


def summary_inputs(texts: DataFrame, limit: int = 4000) -> DataFrame:
    return texts.withColumn("prompt", F.left("text", F.lit(limit)))


def summary_results(answers: DataFrame, unclear: str = "UNCLEAR") -> DataFrame:
    """A model's answers: one that says it is unclear has no summary. answers: tok, answer."""
    none = F.contains(F.upper("answer"), F.lit(unclear))
    return answers.select("tok", none.alias("unclear"), F.when(~none, F.trim("answer")).alias("summary"))
