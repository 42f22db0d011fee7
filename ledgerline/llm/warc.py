"""WARC as a content-addressed archive.

Payload bytes are stored once per SHA-256 digest, in a table bucketed by the digest; exact record headers are kept apart from
them, and records are rebuilt by a join on the digest, which moves headers to the payloads and not payloads again.
Everything is a DataFrame expression; digests are computed again from the stored bytes on reading.

A record is a WARC/1.1 record of type response (its block is an HTTP message: status line, header, payload) or revisit (the
HTTP header alone, with the digest of the payload that it refers to). Record ids are UUIDs of a hash of the row's place and
content, so repeated rows are records of their own.

Defined results: null html is an empty payload; a null page_id counts as larger than every other; repeated rows are
repeated records; several rows with the smallest page_id of a payload are all responses (one stored payload). Line ends in
a url are written as blanks. Extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import ROW_GROUP_BYTES, forget, materialise

MIN_REVISIT_BYTES = 100  # smaller payloads are always written in full
CRAWLED = "1970-01-01T00:00:00Z"  # pages carry no date of their own
SALTS = 16  # tasks that the records of one small payload are dealt over
_LAST = (1 << 63) - 1
_EOL = "\r\n"
_END = _EOL + _EOL


def _header(*lines: tuple[str, Column]) -> Column:
    named = [F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(_EOL)), F.lit("")) for name, value in lines]
    return F.concat(F.lit("WARC/1.1" + _EOL), *named, F.lit(_EOL))


def http_head(n: Column) -> Column:
    """The HTTP header of a payload of n bytes, up to and with its empty line."""
    return F.concat(F.lit(f"HTTP/1.1 200 OK{_EOL}Content-Type: text/html; charset=utf-8{_EOL}Content-Length: "), n.cast("string"), F.lit(_END))


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\u0001", *parts))
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12)), F.lit(">"))


class Archive:
    """The two tables of an archive: payloads (digest, payload), bucketed by digest, and headers (digest, n, header)."""

    def __init__(self, spark: SparkSession, name: str, headers: DataFrame):
        self.spark, self.name, self.headers = spark, name, headers

    @property
    def payloads(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        forget(self.headers)


def archive(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> Archive:
    """Write `pages` (page_id, url, html) as an archive.

    A page whose payload of at least `min_revisit_bytes` equals one of a smaller page_id becomes a revisit record. The header
    block is the exact text of the record up to and with its empty line; n is the length of the whole payload.
    """
    spark = pages.sparkSession
    page = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("page_id").cast("long"), F.lit(_LAST)).alias("key"),
        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ").alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    # Narrow rows, written once, so that every record keeps the place that names it.
    narrow = materialise(page.select("page_id", "key", "url", "digest", F.octet_length("payload").alias("n"), F.monotonically_increasing_id().alias("place")), "warc-pages")
    # One narrow row per digest after the map-side combine: a payload that a third of the rows share is a row a task.
    firsts = narrow.groupBy("digest").agg(F.min(F.struct("key", "place")).alias("first"))
    linked = narrow.join(firsts, "digest")
    revisit = (F.col("n") >= min_revisit_bytes) & (F.col("key") > F.col("first.key"))
    named = lambda key, place: _urn(key.cast("string"), place.cast("string"), F.col("digest"))
    headers = linked.select(
        "digest",
        "n",
        _header(
            ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
            ("WARC-Record-ID", named(F.col("key"), F.col("place"))),
            ("WARC-Date", F.lit(CRAWLED)),
            ("WARC-Target-URI", F.when(F.col("url") != "", F.col("url"))),
            ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
            ("WARC-Refers-To", F.when(revisit, named(F.col("first.key"), F.col("first.place")))),
            ("X-Page-ID", F.col("page_id").cast("string")),
            ("Content-Type", F.when(~revisit, F.lit("application/http; msgtype=response"))),
            ("Content-Length", F.when(revisit, F.lit("0")).otherwise((F.octet_length(http_head(F.col("n"))) + F.col("n")).cast("string"))),
        ).alias("header"),
    )
    written = materialise(headers, "warc-headers")
    # Payloads move once, to their digest's bucket. A task sends one of equal ones, and the bucket keeps one.
    name = f"ledgerline_warc_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = page.select("digest", "payload").dropDuplicates(["digest"])
    stored.write.bucketBy(buckets, "digest").option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).format("parquet").saveAsTable(name)
    forget(narrow)
    return Archive(spark, name, written)


def _whole(payloads: DataFrame) -> DataFrame:
    """digest and payload; bytes that don't match their address fail the query."""
    bad = F.raise_error(F.concat(F.lit("payload differs from its digest "), F.col("digest")))
    return payloads.select("digest", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(bad).alias("payload"))


def records(store: Archive) -> DataFrame:
    """`record`: the exact bytes of every original record, rebuilt from headers and payloads."""
    is_response = F.contains("header", F.lit(f"{_EOL}WARC-Type: response{_EOL}"))
    headers, payloads = store.headers, _whole(store.payloads)
    joined = lambda block: F.concat(F.encode("header", "UTF-8"), block, F.lit(_END.encode()))
    block = F.concat(F.encode(http_head(F.octet_length("payload")), "UTF-8"), F.col("payload"))
    revisits = headers.where(~is_response).select(joined(F.lit(b"")).alias("record"))
    # Headers go to the payloads' buckets and are the side that is hashed; payloads stay where they are.
    large = headers.where(is_response & (F.col("n") >= MIN_REVISIT_BYTES)).hint("shuffle_hash")
    each = payloads.where(F.octet_length("payload") >= MIN_REVISIT_BYTES).join(large, "digest").select(joined(block).alias("record"))
    # Any number of pages may have the same small payload, so that stands in every salt.
    small = headers.where(is_response & (F.col("n") < MIN_REVISIT_BYTES)).withColumn("salt", F.pmod(F.xxhash64("header"), F.lit(SALTS)).cast("int"))
    tiny = payloads.where(F.octet_length("payload") < MIN_REVISIT_BYTES).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    many = small.join(tiny, ["digest", "salt"]).select(joined(block).alias("record"))
    return each.unionByName(many).unionByName(revisits)


def parsed(rebuilt: DataFrame) -> DataFrame:
    """What the bytes of each `record` say: page_id, record_type, record_id, refers_to_record, and the payload's length and
    digest, counted over the bytes of a response and as declared in a revisit. A record whose lengths don't fit fails."""
    head = F.substring_index(F.decode("record", "UTF-8"), _END, 1)
    field = lambda name: F.nullif(F.regexp_extract("head", rf"(?m)^{name}: ([^\r\n]*)", 1), F.lit(""))
    cut = rebuilt.select("record", head.alias("head")).withColumn("length", field("Content-Length").cast("int")).withColumn("at", F.octet_length("head") + 5)
    fits = (F.octet_length("record") == F.col("at") + F.col("length") + 3) & (F.substring("record", F.octet_length("record") - 3, F.lit(4)) == F.lit(_END.encode()))
    block = F.when(fits, F.substring("record", F.col("at"), F.col("length"))).otherwise(F.raise_error(F.concat(F.lit("a record isn't as long as it says: "), F.col("head"))))
    blocks = cut.select("head", block.alias("block"), field("WARC-Type").alias("record_type"))
    http = F.substring_index(F.decode("block", "UTF-8"), _END, 1)
    payload = F.when(F.col("record_type") == "response", F.substring("block", F.octet_length(http) + 5, F.octet_length("block")))
    declared = F.substring_index(field("WARC-Payload-Digest"), ":", -1)
    return blocks.withColumn("payload", payload).select(
        field("X-Page-ID").cast("long").alias("page_id"), "record_type", field("WARC-Record-ID").alias("record_id"), field("WARC-Refers-To").alias("refers_to_record"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.coalesce(F.sha2("payload", 256), declared).alias("payload_digest"),
    )


def read_back(store: Archive) -> DataFrame:
    """A row per record, read from its rebuilt bytes: page_id, payload_bytes, payload_digest, record_type and refers_to.

    A revisit takes the page and the payload of the record that it names; one that names none fails the query.
    """
    found = materialise(parsed(records(store)), "warc-records")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    full = found.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long")).select(*out)
    named = found.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("to_page"), F.col("payload_bytes").alias("to_bytes"), F.col("payload_digest").alias("to_digest"))
    met = found.where("record_type = 'revisit'").join(named, "refers_to_record", "left")
    same = F.when(F.col("to_digest") == F.col("payload_digest"), F.col("to_digest")).otherwise(F.raise_error(F.concat(F.lit("a revisit names no record of its payload: "), F.coalesce("record_id", F.lit("-")))))
    revisits = met.select("page_id", F.col("to_bytes").alias("payload_bytes"), same.alias("payload_digest"), "record_type", F.col("to_page").alias("refers_to"))
    result = materialise(full.unionByName(revisits), "warc-result")
    forget(found)
    return result
