"""All queries with their SQL."""

from __future__ import annotations

from . import catalogue_nights, catalogue_sources, catalogue_texts  # noqa: F401  (they register their queries)
from .catalogue import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
