"""Filters and flags over normalised records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .normalize import from_date_int

#: End dates that stand for "open-ended", as yyyymmdd.
OPEN_ENDED = [20991231, 20990101, 99991231]
#: Relative windows as (column, days from, days to) around the data's date.
WINDOWS = {"began30": ("begin", -30, 0), "began90": ("begin", -90, 0), "ends30": ("end", 0, 30), "ends90": ("end", 0, 90), "ends180": ("end", 0, 180)}
#: Content types of files that aren't read, against pages that may be tried again.
FILE_TYPES = ["image/", "application/msword", "application/vnd.openxmlformats", "application/vnd.ms-", "application/rtf", "text/rtf"]
LEAST_CHARS_PER_PAGE = 50


def in_years(begin: Column, first: int | None, last: int | None) -> Column:
    """Year bounds on yyyymmdd; an undated row (0) is never left out."""
    ok = F.lit(True)
    if first is not None:
        ok &= begin >= first * 10000 + 101
    if last is not None:
        ok &= begin <= last * 10000 + 1231
    return (begin == 0) | ok


def in_amounts(amount: Column, least: Column | None, most: Column | None) -> Column:
    """Amount bounds; a null bound is none."""
    parts = [F.lit(True)]
    if least is not None:
        parts.append(least.isNull() | (amount >= least))
    if most is not None:
        parts.append(most.isNull() | (amount <= most))
    return reduce(lambda a, b: a & b, parts)


def in_window(preset: str, begin: Column, end: Column, as_of: Column) -> Column:
    """Begins or ends within some days of the data's date; undated rows don't. An unknown preset filters nothing."""
    if preset not in WINDOWS:
        return F.lit(True)
    which, low, high = WINDOWS[preset]
    day = from_date_int(begin if which == "begin" else end)
    return F.coalesce(day.between(F.date_add(as_of, low), F.date_add(as_of, high)), F.lit(False))


def oddities(amount: Column, begin: Column, end: Column) -> dict[str, Column]:
    """What looks wrong but is shown as it is."""
    year = lambda d: F.floor(d / 10000)
    strange = lambda d: (d > 0) & ((year(d) < 1900) | (year(d) > 2100)) & ~d.isin(OPEN_ENDED)
    return {
        "negative": amount < 0,
        "reversed": (begin > 0) & (end > 0) & (begin > end),
        "odd_year": strange(begin) | strange(end),
        "open_ended": end.isin(OPEN_ENDED),
    }


def shown_end(end: Column) -> Column:
    """For show; sort on the recorded value."""
    return F.when(end.isin(OPEN_ENDED), F.lit("open-ended")).otherwise(end.cast("string"))


def unknown_values(dim: DataFrame, column: str, wanted: list[str]) -> list[str]:
    """Filter values that the dimension doesn't have: to be reported, not dropped."""
    have = {r[0] for r in dim.where(F.col(column).isin(wanted)).select(column).distinct().collect()} if wanted else set()
    return [w for w in wanted if w not in have]


def never_proven_absent(status: Column, detail: Column) -> Column:
    """Worth another try: unavailable, but no 404 said so."""
    return (status == "unavailable") & ~F.contains(F.coalesce(detail, F.lit("")), F.lit("404"))


def all_failed(errors: Column) -> Column:
    """errors: map of engine to error. True if there is none or each has an error."""
    return F.coalesce(F.size(errors) <= 0, F.lit(True)) | F.forall(F.map_values(errors), lambda e: e.isNotNull())


def text_verdict(chars: Column, pages: Column) -> Column:
    """text from 50 characters a page on, else scanned."""
    return F.when(chars / F.greatest(pages, F.lit(1)) < LEAST_CHARS_PER_PAGE, "scanned").otherwise("text")


def non_pdf_verdict(content_type: Column, body: Column) -> Column:
    """struct(status, sha256, head): file types are unsupported for good, everything else is an error to retry."""
    is_file = reduce(lambda a, b: a | b, [F.startswith(F.lower(content_type), F.lit(t)) for t in FILE_TYPES])
    return F.struct(
        F.when(F.coalesce(is_file, F.lit(False)), "unsupported").otherwise("error").alias("status"), F.sha2(body, 256).alias("sha256"), F.left(F.trim(F.regexp_replace(F.left(body.cast("string"), F.lit(2000)), r"(?U)\s+", " ")), F.lit(300)).alias("head")
    )


def run_code(total: Column, errors: Column) -> Column:
    """2 if more than half failed; nothing to do is success."""
    return F.when((total > 0) & (errors * 2 > total), 2).otherwise(0)
