"""HTML pages as rows: result grids, file tables, option lists. Column expressions on whole pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .schemas import RECORD

#: Ids of result tables and the order of a row's cells.
GRID_IDS = ["entitygrid", "agencygrid"]
GRID_CELLS = ["doc_number", "doc_type", "entity_code", "entity_name", "vendor", "amount", "begin_date", "end_date"]


def unescaped(c: Column) -> Column:
    for entity, raw in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(raw))
    return c


def cell_text(c: Column) -> Column:
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(c, r"(?s)<[^>]*>", " ")), r"(?U)\s+", " "))


def grid(pages: DataFrame, html: str = "html") -> DataFrame:
    """page columns, then the cells of each row with eight cells and more, detail_url and last_page (the largest page that
    the pager links to; null without one)."""
    table = F.regexp_extract(html, rf"(?is)<table[^>]*\bid=[\"'](?:{'|'.join(GRID_IDS)})[\"'][^>]*>(.*?)</table>", 1)
    foot = F.regexp_extract("_t", r"(?is)<tfoot[^>]*>(.*?)</tfoot>", 1)
    pages_named = F.transform(F.regexp_extract_all(unescaped(foot), F.lit(r"(?i)\bhref=[\"'][^\"']*[?&]page=(\d+)"), F.lit(1)), lambda x: x.cast("int"))
    body = F.regexp_replace("_t", r"(?is)<(tfoot|thead)[^>]*>.*?</\1>", "")
    rows = pages.withColumn("_t", table).withColumn("last_page", F.array_max(pages_named)).withColumn("_row", F.explode(F.regexp_extract_all(body, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))))
    cells = rows.withColumn("_c", F.regexp_extract_all("_row", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1))).where(F.size("_c") >= len(GRID_CELLS))
    link = unescaped(F.regexp_extract("_row", r"(?is)<a[^>]*\bhref=[\"']([^\"']*)[\"']", 1))
    named = [cell_text(F.get("_c", F.lit(k))).alias(n) for k, n in enumerate(GRID_CELLS)]
    return cells.select(*[c for c in pages.columns if c != html], *named, link.alias("detail_url"), "last_page")


def record_rows(cells: DataFrame, entities: DataFrame, status: str) -> DataFrame:
    """Rows of the record files from grid cells: the entity's own spelling (grids shout), the status, no view URL yet.

    entities: entity_name. A row of an entity that isn't known is left out.
    """
    names = entities.select(F.col("entity_name").alias("_own"), F.upper("entity_name").alias("_key"))
    joined = cells.withColumn("_key", F.upper("entity_name")).join(names, "_key")
    return joined.select(*[F.col("_own").alias(c) if c == "entity_name" else F.lit(status).alias(c) if c == "status" else F.lit("").alias(c) if c == "view_url" else F.col(c) for c in RECORD.names])


def file_links(pages: DataFrame, html: str = "html", pattern: str = r"ViewDocument\?D=([^\"'&]+)") -> DataFrame:
    """page columns, position, name, token: links to files, the first of each token, in page order."""
    link = rf"(?is)<a[^>]*\bhref=[\"'][^\"']*{pattern}[^\"']*[\"'][^>]*>(.*?)</a>"
    both = F.arrays_zip(F.regexp_extract_all(html, F.lit(link), F.lit(1)).alias("token"), F.regexp_extract_all(html, F.lit(link), F.lit(2)).alias("name"))
    kept = [c for c in pages.columns if c != html]
    zipped = pages.select(*kept, both.alias("_l")).withColumn("_l", F.filter("_l", lambda x, i: F.array_position(F.col("_l.token"), x["token"]) == i + 1))
    return zipped.select(*kept, F.posexplode("_l").alias("position", "_x")).select(*kept, "position", cell_text(F.col("_x.name")).alias("name"), unescaped(F.col("_x.token")).alias("token"))


def bound_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once: a column named in a lambda is otherwise read, or computed, at every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def first_of_each(items: Column, field: str) -> Column:
    """Of an array of structs the first of each value of a field, in the array's order: by sorting, as pages can be long."""

    def kept(all_: Column) -> Column:
        places = F.sort_array(F.transform(all_, lambda x, i: F.struct(x[field].alias("value"), i.alias("i"))))
        firsts = bound_once(places, lambda p: F.filter(p, lambda x, k: (k == 0) | ~F.get(p, k - 1)["value"].eqNullSafe(x["value"])))
        return F.transform(F.sort_array(F.transform(firsts, lambda x: x["i"])), lambda i: F.get(all_, i))

    return bound_once(items, kept)


def document_list(pages: DataFrame, html: str = "html") -> DataFrame:
    """page columns, documents: name, size and token of each file row, first per token; null where the page is null."""
    row = r"(?is)<tr[^>]*>\s*<td[^>]*>(?:(?!</td>).)*?ViewDocument[^\"']*?D=([^\"']+)[^>]*>(.*?)</a>\s*</td>\s*<td[^>]*>(.*?)</td>"
    part = lambda k: F.regexp_extract_all(html, F.lit(row), F.lit(k))
    zipped = F.arrays_zip(part(2).alias("name"), part(3).alias("size"), part(1).alias("token"))
    first = pages.withColumn("_d", first_of_each(zipped, "token"))
    clean = F.transform("_d", lambda x: F.struct(cell_text(x["name"]).alias("name"), cell_text(x["size"]).alias("size"), x["token"].alias("token")))
    return first.select(*[c for c in pages.columns if c != html], clean.alias("documents"))


def options(pages: DataFrame, html: str = "html", skip: tuple[str, ...] = ("", "ALL-999-000")) -> DataFrame:
    """page columns, name, value of each <option>, without the ones that choose nothing."""
    pattern = r"(?is)<option[^>]*\bvalue=[\"']([^\"']*)[\"'][^>]*>(.*?)</option>"
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("value"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("name"))
    kept = [c for c in pages.columns if c != html]
    return pages.select(*kept, F.explode(pairs).alias("o")).select(*kept, cell_text(F.col("o.name")).alias("name"), unescaped(F.col("o.value")).alias("value")).where(~F.col("value").isin(*skip))
