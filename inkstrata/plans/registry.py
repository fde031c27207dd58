"""All registered queries and their SQL."""

from __future__ import annotations

from inkstrata.plans import documents, repairs  # noqa: F401  register their queries
from inkstrata.plans.catalog import ORACLE_SQL, QUERIES

FLAGSHIP = "sections_from_pages"

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
