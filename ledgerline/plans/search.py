"""Interactive search over published records: parameters to filters, sort, page and permalink."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from urllib.parse import parse_qs, urlencode

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.normalize import bound
from ..functions.search import lookup, vendor_matches
from ..operators.fold import numbered

SORTS = ["amount_value", "begin", "end", "vendor", "entity_name", "doc_number"]


@dataclass
class Query:
    """Search state. Empty fields filter nothing."""

    vendor: str = ""
    words: str = ""
    agencies: list[str] = field(default_factory=list)
    types: list[str] = field(default_factory=list)
    status: str = ""
    year_from: int | None = None
    year_to: int | None = None
    least: str = ""
    most: str = ""
    when: str = ""
    sort: str = "amount_value"
    ascending: bool = False

    def permalink(self) -> str:
        blank = asdict(Query())
        return urlencode({k: v for k, v in asdict(self).items() if v != blank[k]}, doseq=True)

    @staticmethod
    def parsed(text: str) -> "Query":
        found, q = parse_qs(text.lstrip("?")), Query()
        for k, v in found.items():
            if hasattr(q, k):
                kind = getattr(q, k)
                setattr(q, k, v if isinstance(kind, list) else v[0] == "True" if isinstance(kind, bool) else int(v[0]) if k.startswith("year_") and v[0].isdigit() else v[0])
        return q


def prioritised(rows: DataFrame, name: str, first: list[str]) -> DataFrame:
    """`rows` with `place`: names of `first` in their order, then all others by name."""
    at = F.array_position(F.array(*map(F.lit, first)), F.col(name))
    return numbered(rows.withColumn("_at", F.when(at > 0, at).otherwise(len(first) + 1)), ["_at", name], "place").drop("_at")


def search(rows: DataFrame, query: Query, as_of: str, index: DataFrame | None = None) -> DataFrame:
    """Matching rows in order, ties by row_id. Vendors are matched over distinct names, words through the index."""
    c = F.col
    out = rows
    if query.status:
        out = out.where(c("status") == query.status)
    if query.agencies:
        out = out.where(c("entity_name").isin(query.agencies))
    if query.types:
        out = out.where(c("type_group").isin(query.types))
    out = out.where(P.in_years(c("begin"), query.year_from, query.year_to))
    out = out.where(P.in_amounts(c("amount_value"), bound(F.lit(query.least)), bound(F.lit(query.most))))
    if query.when:
        out = out.where(P.in_window(query.when, c("begin"), c("end"), F.lit(as_of).cast("date")))
    if query.vendor.strip():
        names = rows.select("vendor").distinct().where(vendor_matches(c("vendor"), query.vendor))
        out = out.join(names, "vendor", "left_semi")
    if query.words.strip() and index is not None:
        typed = query.words.lower().split()
        out = out.join(lookup(index, typed[:-1], typed[-1:]), "row_id", "left_semi")
    key = c(query.sort if query.sort in SORTS else SORTS[0])
    return out.orderBy(key.asc() if query.ascending else key.desc(), "row_id")
