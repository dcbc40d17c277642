"""The registered queries, each with the SQL that must give the same rows."""

from snapmart.catalog import (  # noqa: F401  (importing registers the queries)
    aggregates,
    checks,
    cleaning,
    lookups,
    merges,
    monitoring,
    runs,
    scans,
    streams,
    writes,
)
from snapmart.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
