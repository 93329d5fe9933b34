"""Registered queries: each operator over the benchmark tables, with its SQL where it has one."""

from filetally.catalog.registry import QUERIES, SQL_CHECKS
from filetally.catalog import (  # noqa: F401  (importing registers the queries)
    columns,
    edges,
    inventory,
    migration,
    reconciliation,
    streams,
    writing,
)

__all__ = ["QUERIES", "SQL_CHECKS"]
