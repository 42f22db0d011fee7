"""Money, dates, URLs, keys and words as column expressions; only `unpacked_list` needs Python."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN_COUNT = 255  # a document count that nobody has read
COUNT_LIMIT = 254
BLOCK_ROWS = 2048
#: Words that tell spellings of a firm apart without naming it.
NOISE_WORDS = ["INC", "INCORPORATED", "LLC", "L L C", "LLP", "LTD", "CO", "CORP", "CORPORATION", "COMPANY", "COMPANIES", "THE", "OF", "AND", "DBA", "PC", "PLLC", "LP"]


def flatten(c: Column) -> Column:
    """One space for every run of white space (Unicode's, too), none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def money(c: Column) -> Column:
    """`$4,920.00` to 4920.0. What isn't a finite number as a whole counts as 0.0."""
    bare = F.regexp_replace(F.regexp_replace(c, r"(?U)[$,]|^\s+|\s+\z", ""), r"(?<=\d)_(?=\d)", "")
    bare = F.regexp_replace(bare, r"(?U)^\s+|\s+\z", "")
    number = F.when(bare.rlike(r"\A[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"), bare.try_cast("double"))
    finite = F.when(F.isnan(number) | (F.abs(number) == float("inf")), None).otherwise(number)
    return F.round(F.coalesce(finite, F.lit(0.0)), 2)


def bound(c: Column) -> Column:
    """A typed amount bound: null (no bound) unless the whole of it is a number."""
    bare = F.regexp_replace(c, r"(?U)[$,\s]", "")
    return F.when(bare.rlike(r"\A[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"), bare.try_cast("double"))


def date_int(c: Column) -> Column:
    """`M/D/YYYY` to yyyymmdd without a calendar check; 0 unless there are three whole numbers."""
    parts = F.split(c, "/")
    whole = F.forall(parts, lambda p: p.rlike(r"\A\s*[+-]?\d+\s*\z"))
    n = [F.trim(F.get(parts, F.lit(k))).try_cast("long") for k in range(3)]
    return F.coalesce(F.when((F.size(parts) == 3) & whole, n[2] * 10000 + n[0] * 100 + n[1]), F.lit(0)).cast("long")


def real_date(c: Column) -> Column:
    """`M/D/YYYY` as a date of the calendar, else null."""
    return F.try_to_timestamp(c, F.lit("M/d/yyyy")).cast("date")


def from_date_int(c: Column) -> Column:
    return F.try_to_timestamp(c.cast("string"), F.lit("yyyyMMdd")).cast("date")


def strict_timestamp(c: Column) -> Column:
    """ISO-8601 with an offset or Z; null without one."""
    return F.when(c.rlike(r"\A\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d+)?)?(Z|[+-]\d\d:?\d\d)\z"), F.try_to_timestamp(c))


def build_time(c: Column) -> Column:
    """`YYYYMMDD-HHMMSS` (UTC)."""
    return F.try_to_timestamp(c, F.lit("yyyyMMdd-HHmmss"))


def night_of(ts: Column, zone: str = "America/Chicago") -> Column:
    """The night a moment belongs to: it begins at local noon."""
    return F.to_date(F.from_utc_timestamp(ts, zone) - F.expr("INTERVAL 12 HOURS"))


def query_param(url: Column, name: str) -> Column:
    """First value of a query parameter, decoded; empty if missing."""
    return F.coalesce(F.try_url_decode(F.try_parse_url(url, F.lit("QUERY"), F.lit(name))), F.lit(""))


def rebuilt_url(base: Column, **params: Column) -> Column:
    """A URL from its decoded parameters, `%20` for a blank."""
    pairs = [F.concat(F.lit(f"{k}="), F.replace(F.url_encode(v), F.lit("+"), F.lit("%20"))) for k, v in params.items()]
    return F.concat(base, F.lit("?"), F.concat_ws("&", *pairs))


def view_suffix(url: Column, prefix: str) -> Column:
    """What follows the fixed prefix of a view URL; another prefix fails the query, an empty URL stays empty."""
    bad = F.raise_error(F.concat(F.lit("unexpected view URL: "), url))
    return F.when(url == "", F.lit("")).when(F.startswith(url, F.lit(prefix)), F.substr(url, F.lit(len(prefix) + 1))).otherwise(bad)


def token_bytes(c: Column) -> Column:
    """A URL-quoted base64 token as bytes."""
    return F.unbase64(F.url_decode(c))


def token_text(c: Column) -> Column:
    return F.url_encode(F.base64(c))


def key_hash(url: Column) -> Column:
    """A 24-digit hex key of a URL; a key that is one already passes through."""
    return F.when(url.rlike(r"\A[0-9a-f]{24}\z"), url).otherwise(F.substring(F.sha2(url, 256), 1, 24))


def shard_of(c: Column, n: int) -> Column:
    """md5 as one number modulo n, from its two 64-bit halves."""
    hexes = F.md5(c)
    half = lambda a: F.conv(F.substring(hexes, a, 16), 16, 10).cast("decimal(20,0)")
    high, low = (half(1) % n).cast("long"), (half(17) % n).cast("long")
    return ((high * ((1 << 64) % n) + low) % n).cast("int")


def vendor_key(name: Column) -> Column:
    """A rough key of one firm's spellings: no trailing number, no legal words, letters and digits only."""
    # A number at the end goes with the signs around it; signs alone would become blanks below anyway.
    blanks = " \t\n\r\f\x0b"
    c = F.rtrim(F.rtrim(F.upper(name), F.lit("0123456789.-" + blanks)), F.lit(".,#-" + blanks))
    c = F.regexp_replace(c, rf"\b({'|'.join(NOISE_WORDS)})\b", " ")
    c = F.regexp_replace(c, r"[^A-Z0-9 ]", " ")
    return F.trim(F.regexp_replace(c, " +", " "))


def display_name(c: Column) -> Column:
    """For show only: runs of white space and control characters as one space."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s\p{Cntrl}]+", " "))


def shard_letter(c: Column) -> Column:
    """First letter A-Z, else `_`."""
    first = F.upper(F.left(F.trim(c), F.lit(1)))
    return F.when(first.rlike("^[A-Z]$"), first).otherwise("_")


def index_words(c: Column, least: int = 2) -> Column:
    """Distinct lower-case words of letters and digits with at least `least` characters."""
    return F.filter(F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))), lambda w: F.length(w) >= least)


def clamp_count(n: Column) -> Column:
    """A document count for one byte: unknown is 255, the rest at most 254."""
    return F.when(n.isNull(), UNKNOWN_COUNT).otherwise(F.least(n, F.lit(COUNT_LIMIT))).cast("int")


def csv_guard(c: Column) -> Column:
    """A text cell that a spreadsheet would run as a formula gets an apostrophe."""
    return F.when(c.rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), c)).otherwise(c)


def json_field(c: Column, schema: str, *path: str) -> Column:
    """A field of a JSON text, through structs and maps; null where it isn't there."""
    out = F.from_json(c, schema)
    for name in path:
        out = out.getItem(name)
    return out


def packed_list(items: Column, *fields: str) -> Column:
    """A list of structs of strings as bytes: each string behind its length (four bytes)."""
    size = lambda b: F.unhex(F.lpad(F.hex(F.octet_length(b)), 8, "0"))
    one = lambda x: F.concat(*[p for f in fields for b in [F.encode(F.coalesce(x[f], F.lit("")), "UTF-8")] for p in (size(b), b)])
    return F.unhex(F.array_join(F.transform(items, lambda x: F.hex(one(x))), ""))


def unpacked_list(raw: Column, *fields: str) -> Column:
    """What `packed_list` has packed. Bytes or strings that are left over, or too few, give null.

    Each length tells where the next one stands, and a column expression that goes on like this copies all that it has found
    at every step, so this runs in Python on Arrow buffers.
    """

    def unpacked(raws: pa.Array) -> pa.Array:
        columns, ends, null = [[] for _ in fields], [0], []
        for x in raws:
            found = _strings(x.as_py())
            null.append(found is None or len(found) % len(fields) > 0)
            for i, column in enumerate(columns):
                column += [] if null[-1] else found[i :: len(fields)]
            ends.append(len(columns[0]))
        texts = [pa.array(column, pa.binary()).cast(pa.string()) for column in columns]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(texts, fields), mask=pa.array(null, pa.bool_()))

    kind = T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in fields]))
    return F.arrow_udf(unpacked, kind)(raw)


def _strings(raw: bytes | None) -> list[bytes] | None:
    """Strings that stand behind their lengths; none unless they end with the bytes."""
    out, at = [], 0
    while raw is not None and at < len(raw):
        start = at + 4
        at = start + int.from_bytes(raw[at:start], "big")
        out.append(raw[start:at])
    return out if raw is not None and at == len(raw) else None


def varint_deltas(ids: Column) -> Column:
    """Ascending numbers as bytes: each difference in groups of seven bits, the lowest first, the high bit set while more follow."""
    deltas = F.transform(ids, lambda x, i: x - F.when(i > 0, F.get(ids, i - 1)).otherwise(0))
    group = lambda d, k: F.shiftright(d, 7 * k).bitwiseAND(127)
    byte = lambda d, k: F.lpad(F.hex(group(d, k) + F.when(F.shiftright(d, 7 * (k + 1)) > 0, 128).otherwise(0)), 2, "0")
    one = lambda d: F.concat(byte(d, 0), *[F.when(F.shiftright(d, 7 * k) > 0, byte(d, k)).otherwise("") for k in range(1, 9)])
    return F.unhex(F.array_join(F.transform(deltas, one), ""))


def from_varint_deltas(raw: Column) -> Column:
    """The numbers that `varint_deltas` has written."""
    kind = "struct<shift:int,part:bigint,last:bigint,out:array<bigint>>"
    start = F.struct(F.lit(0).alias("shift"), F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("last"), F.array().cast("array<bigint>").alias("out")).cast(kind)
    places = F.when(F.octet_length(raw) > 0, F.sequence(F.lit(1), F.octet_length(raw))).otherwise(F.array().cast("array<int>"))

    def step(s: Column, at: Column) -> Column:
        byte = F.conv(F.hex(F.substring(raw, at, F.lit(1))), 16, 10).cast("long")
        part = s["part"] + byte.bitwiseAND(127) * F.pow(F.lit(2), s["shift"]).cast("long")
        more = F.struct((s["shift"] + 7).alias("shift"), part.alias("part"), s["last"].alias("last"), s["out"].alias("out"))
        done = F.struct(F.lit(0).alias("shift"), F.lit(0).cast("long").alias("part"), (s["last"] + part).alias("last"), F.array_append(s["out"], s["last"] + part).alias("out"))
        return F.when(byte >= 128, more.cast(kind)).otherwise(done.cast(kind)).cast(kind)

    return F.aggregate(places, start, step)["out"]


def capped(text: Column, limit: int = 4000) -> Column:
    """struct(text, clipped)."""
    return F.struct(F.left(text, F.lit(limit)).alias("text"), (F.length(text) > limit).alias("clipped"))
