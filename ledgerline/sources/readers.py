"""Scans. Logs keep the order of their lines; a torn last line is told from a broken one."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fold import latest
from .schemas import RECORD


def records(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Record files by dataset name, all text, with `dataset` and `seq` (the order of rows within a file)."""
    out = None
    for dataset, path in paths.items():
        df = spark.read.schema(RECORD).option("header", True).option("escape", '"').option("multiLine", True).csv(path)
        df = df.fillna("").select("*", F.lit(dataset).alias("dataset"), _sequence().alias("seq"))
        out = df if out is None else out.unionByName(df)
    return out


def whole_records(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Record files of which the last write may have been cut off: a row that no line feed ends is dropped.

    An odd number of quotes means that a cut lies inside a field; such a file is refused.
    """
    out = None
    for dataset, path in paths.items():
        quotes = spark.read.option("lineSep", "\n").text(path).agg(F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("n")).first().n
        if (quotes or 0) % 2:
            raise ValueError(f"{path}: a quote is open at the end")
        df = records(spark, {dataset: path})
        if cut := unended_files(spark, path):
            last = df.groupBy(F.col("seq.file").alias("file")).agg(F.max("seq").alias("last"))
            df = df.join(last, F.col("seq.file") == F.col("file")).where((F.col("seq") != F.col("last")) | ~_named("file", cut)).drop("file", "last")
        out = df if out is None else out.unionByName(df)
    return out


def keyed_records(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The same without rows that have no key."""
    return records(spark, paths).where("detail_url <> ''")


def _sequence() -> Column:
    """A number that follows the order of rows in files: file, block, then position."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """value, seq of every line. Only a line feed ends a line; other separators are data."""
    return spark.read.option("lineSep", "\n").text(path).select("value", _sequence().alias("seq"))


def jsonl(spark: SparkSession, path: str, schema: str, strict_tail: bool = False) -> DataFrame:
    """Parsed lines with `seq`. A last line that doesn't parse was torn and is dropped; an earlier one fails the query.

    strict_tail: also drop a last line that no line feed ends, even if it parses.
    """
    rows = lines(spark, path).where(F.trim(F.regexp_replace("value", "\r", "")) != "")
    names = spark.createDataFrame([], schema).schema
    # Whether a line is JSON is asked apart from its fields: the optimizer prunes what from_json has to look at.
    parsed = rows.select("seq", "value", F.try_parse_json("value").isNull().alias("bad"))
    # One narrow aggregation finds each file's last line: a row per file.
    last = rows.groupBy(F.col("seq.file").alias("file")).agg(F.max("seq").alias("last"))
    unended = _named("file", unended_files(spark, path) if strict_tail else [])
    joined = parsed.join(last, F.col("seq.file") == F.col("file"))
    whole = joined.where(~((F.col("seq") == F.col("last")) & (F.col("bad") | unended)))
    # The last line is named here again, so that no filter on the fields can move this check in front of the join.
    checked = F.when(~F.col("bad"), F.col("value")).when(F.col("seq") == F.col("last"), None).otherwise(F.raise_error(F.concat(F.lit("a line before the last one doesn't parse: "), F.left("value", F.lit(200)))))
    return whole.select("seq", F.from_json(checked, names).alias("v")).select(*[f"v.{n}" for n in names.names], "seq")


def _named(file: str, names: list[str]) -> Column:
    """Whether a file's path ends in one of these folder/file names."""
    return F.substring_index(file, "/", -2).isin(names) if names else F.lit(False)


def unended_files(spark: SparkSession, path: str) -> list[str]:
    """folder/file of each file whose last byte isn't a line feed (an empty file counts as whole)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    target = hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s for s in (fs.globStatus(target) or [])]
    files = [f for s in found for f in (fs.listStatus(s.getPath()) if s.isDirectory() else [s]) if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    out = []
    for f in files:
        if f.getLen():
            stream = fs.open(f.getPath())
            stream.seek(f.getLen() - 1)
            last = stream.read()
            stream.close()
            if last != 10:
                out.append(f"{f.getPath().getParent().getName()}/{f.getPath().getName()}")
    return out


def folded(spark: SparkSession, path: str, schema: str, key: str, strict_tail: bool = False) -> DataFrame:
    """A log with the last line of each key; lines without the key are skipped."""
    return latest(jsonl(spark, path, schema, strict_tail).where(F.col(key).isNotNull()), [key], "seq").drop("seq")


def source_texts(ocr: DataFrame, engine: str) -> DataFrame:
    """Newest text per token among lines that have one: a later line without text doesn't take an earlier text away."""
    text = F.col("engines")[engine]["text"]
    return latest(ocr.where("tok is not null").withColumn("text", text).where(F.coalesce(F.trim("text"), F.lit("")) != ""), ["tok"], "seq").select("tok", "doc", "text")


def reference_map(spark: SparkSession, path: str) -> DataFrame:
    """key, value of a JSON object file; keys that begin with `_` are comments. Lists are exploded by `reference_lists`."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.explode(F.from_json("value", "map<string,string>"))).where(~F.startswith("key", F.lit("_")))


def reference_lists(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("wholetext", True).text(path)
    pairs = text.select(F.explode(F.from_json("value", "map<string,array<string>>"))).where(~F.startswith("key", F.lit("_")))
    return pairs.select("key", F.explode("value").alias("value"))


def newest_tag(releases: DataFrame, wanted: str) -> DataFrame:
    """The release tagged exactly so, else the greatest tag that begins with it."""
    fits = releases.where(F.startswith("tag", F.lit(wanted)))
    return fits.agg(F.coalesce(F.max(F.when(F.col("tag") == wanted, F.struct("tag"))), F.max(F.struct("tag"))).alias("r")).select("r.tag").where("tag is not null")


def asset(releases: DataFrame, assets: DataFrame, wanted: str, name: str) -> DataFrame:
    """tag, name, size of a file of the wanted release. assets: tag, name, size."""
    return assets.where(F.col("name") == name).join(newest_tag(releases, wanted), "tag").select("tag", "name", "size")


def state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small JSON state table; empty if there is none. A file that can't be read is set aside as .corrupt."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    target = hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return spark.createDataFrame([], schema)
    text = "\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect())
    try:
        for line in text.split("\n"):
            if line.strip():
                json.loads(line)
    except ValueError:
        fs.rename(target, hadoop.fs.Path(path.rstrip("/") + ".corrupt"))
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)
