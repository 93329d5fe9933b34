"""Name to query and name to DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from filetally.fixtures import as_ctes, fixture
from filetally.sources.listing import as_listing_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL_CHECKS: dict[str, str] = {}


def query(sql: str | None = None, uses: str = ""):
    """Register a query under its function name; ``uses`` names the fixtures of its SQL."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            body = sql.strip()
            if uses:
                tail = body[5:] if body.startswith("WITH ") else None
                body = as_ctes(*uses.split()) + (f", {tail}" if tail else f"\n{body}")
            SQL_CHECKS[function.__name__] = body
        return function

    return register


def file_listing(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A file fixture as listing rows."""
    return as_listing_rows(
        fixture(spark, sf_dir, name).selectExpr(
            "*", "file_id AS id", "'file' AS entry_type", "lower(path_display) AS path_lower",
            "floor(ordinal / 100) AS page",
        )
    )


def change_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log as listing rows of files, folders and deletions."""
    return as_listing_rows(
        fixture(spark, sf_dir, "fx_change_log").selectExpr(
            "page", "ordinal", "entry_type", "name", "path_display",
            "lower(path_display) AS path_lower",
            "CASE WHEN entry_type <> 'deleted' THEN file_id END AS id",
            *[
                f"CASE WHEN entry_type = 'file' THEN {c} END AS {c}"
                for c in ("rev", "size", "content_hash")
            ],
        )
    )
