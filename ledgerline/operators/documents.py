"""Records joined with their documents, descriptions and summaries. Unknown stays null; it is never zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import DESCRIPTION_SOURCES
from ..sources.scratch import written
from .fold import best_by_rank


def with_counts(rows: DataFrame, log: DataFrame, key: str = "k") -> DataFrame:
    """Left join on the URL's key: n and documents are null where nobody has looked."""
    return rows.join(log.select(key, "n", "documents"), key, "left")


def log_entry(n: Column, documents: Column) -> Column:
    """The list is only kept of two documents and more."""
    return F.when(n > 1, documents)


def positions(rows: DataFrame) -> DataFrame:
    """token, row_id, position, is_primary: the places of each document. rows: row_id, view_token, documents."""
    listed = rows.where(F.size("documents") > 1).select("row_id", F.posexplode(F.col("documents.token")).alias("position", "token"))
    single = rows.where((F.col("view_token") != "") & (F.coalesce(F.size("documents"), F.lit(0)) <= 1)).select("row_id", F.lit(0).alias("position"), F.col("view_token").alias("token"))
    return listed.unionByName(single).select("token", "row_id", "position", (F.col("position") == 0).alias("is_primary")).distinct()


def described(places: DataFrame, scope: DataFrame) -> DataFrame:
    """row_id with its best description: the first document's, else the earliest position; of equal ones the later line.

    scope: tok, source, description, seq. A source that isn't known counts as `unknown`.
    """
    known = F.when(F.col("source").isin(DESCRIPTION_SOURCES), F.col("source")).otherwise("unknown")
    met = scope.join(places, scope["tok"] == places["token"]).select("row_id", F.when(F.col("is_primary"), 0).otherwise(1 + F.col("position")).alias("rank"), "seq", "description", known.alias("source"), "position")
    return best_by_rank(met, ["row_id"], "rank", "seq").select("row_id", "description", "source", "position")


def summarised(rows: DataFrame, places: DataFrame, summaries: DataFrame, models: list[str]) -> DataFrame:
    """row_id with its best summary; a token shared by rows serves each of them.

    summaries: tok, model, summary, unclear, seq. Unclear ones and errors carry no text. A model that isn't known fails the
    query if a row carries the token, and does no harm otherwise. A row whose own list lacks the token has position null.
    """
    good = summaries.where("summary is not null and not coalesce(unclear, false) and tok is not null")
    # Of a token's summaries only the latest can be a row's best, so one row a token meets the places, not each summary each row.
    odd = F.max(F.when(F.coalesce(~F.col("model").isin(models), F.lit(True)), F.coalesce("model", F.lit("none"))))
    best = good.groupBy("tok").agg(F.max_by(F.struct("seq", "summary", "model"), F.struct("seq")).alias("s"), odd.alias("odd"))
    # It is written, so that its size is known: a small one is broadcast and the places stay where they are.
    best = written(best, "summaries")
    # A row's own token counts at its place in the list, and has none if the list lacks it. Of equal tokens the first place counts.
    own = rows.where("view_token <> ''").select(F.col("view_token").alias("token"), "row_id", F.lit(None).cast("int").alias("position"))
    every = places.select("token", "row_id", F.col("position").cast("int").alias("position")).unionByName(own).groupBy("row_id", "token").agg(F.min("position").alias("position"))
    model = F.when(F.col("odd").isNull(), F.col("s.model")).otherwise(F.raise_error(F.concat(F.lit("unknown model: "), "odd")))
    met = every.join(best, every["token"] == best["tok"]).select("row_id", F.coalesce("position", F.lit(0)).alias("rank"), F.col("s.seq").alias("seq"), F.col("s.summary").alias("summary"), model.alias("model"), "position")
    return best_by_rank(met, ["row_id"], "rank", "seq").select("row_id", "summary", "model", "position")


def known_models(prior: DataFrame) -> list[str]:
    """The models that a build's summaries name: a handful, so they are a list."""
    return sorted(r.model for r in prior.where("model is not null").select("model").distinct().collect())


def carried_forward(prior: DataFrame, current: DataFrame, token: str = "token") -> DataFrame:
    """What the last build said about tokens that rows still carry, for those that the new logs don't describe."""
    keep = prior.join(current.select(token).distinct(), token, "left_semi")
    return keep


def with_floor(fresh: DataFrame, prior: DataFrame, keys: list[str]) -> DataFrame:
    """Fresh rows, and prior ones of keys without a fresh row."""
    return fresh.unionByName(prior.join(fresh.select(*keys).distinct(), keys, "left_anti").select(*fresh.columns))


def extra_targets(rows: DataFrame, described_tokens: DataFrame) -> DataFrame:
    """Second and further documents to read, those first whose first document isn't described. rows: row_id, documents."""
    many = rows.where(F.size("documents") > 1).withColumn("head", F.element_at("documents", 1)["token"])
    flag = described_tokens.select(F.col("token").alias("head")).distinct().withColumn("has", F.lit(True))
    found = many.join(flag, "head", "left").select("row_id", F.coalesce("has", F.lit(False)).alias("first_described"), F.posexplode(F.slice("documents", F.lit(2), F.size("documents"))).alias("i", "d"))
    return found.select("row_id", (F.col("i") + 1).alias("position"), F.col("d.token").alias("token"), "first_described").orderBy("first_described", "row_id", "position")


def own_tokens(documents: Column) -> Column:
    """A row's own document tokens in list order."""
    return F.transform(documents, lambda d: d["token"])


def first_token(documents: Column) -> Column:
    return F.when(F.size(documents) > 0, F.element_at(documents, 1)["token"]).otherwise("")


def to_do(targets: DataFrame, done: DataFrame, key: str, retry: Column) -> DataFrame:
    """Targets that aren't done, or whose last result may be tried again."""
    settled = done.where(~F.coalesce(retry, F.lit(False))).select(key).distinct()
    return targets.join(settled, key, "left_anti")


def coverage(rows: DataFrame, log: DataFrame, key: str = "k") -> DataFrame:
    """Per dataset: rows, rows that were checked, rows with several documents, documents."""
    met = rows.join(log.select(key, "n"), key, "left")
    return met.groupBy("dataset").agg(F.count("*").alias("total"), F.count("n").alias("checked"), F.count_if(F.col("n") > 1).alias("multi"), F.coalesce(F.sum("n"), F.lit(0)).alias("documents"))


def source_counts(rows: DataFrame, source: str, dim: list[str]) -> DataFrame:
    """code, source, n for every known source; code 0 is all the rest."""
    spark = rows.sparkSession
    codes = spark.createDataFrame(list(enumerate(dim)), "code long, source string")
    counts = rows.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("total"))
    known = codes.where("code > 0").join(counts, "source", "left").select("code", "source", F.coalesce("n", F.lit(0)).alias("n"))
    rest = known.agg(F.sum("n").alias("s")).crossJoin(total).select(F.lit(0).cast("long").alias("code"), F.lit(dim[0]).alias("source"), (F.col("total") - F.coalesce("s", F.lit(0))).alias("n"))
    return known.unionByName(rest)
