"""Two-sided reconciliation: path by path comparison of two complete inventories."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.errors import ConfigurationError
from filetally.functions.paths import relative_path
from filetally.functions.times import format_utc, to_instant
from filetally.guards import require
from filetally.operators.keyed import assert_unique, named, pair_by_key, unique_sides
from filetally.session import require_utc

STATUSES = ("matched", "missing", "mismatched", "extra_destination", "error")


class Inventory(NamedTuple):
    """One side's files, one row each: usable paths and path issues together.

    ``issue`` tells the two apart; ``sort_key`` is the normalized path, or the place of an
    issue in the listing. Places can be missing or repeated, so ``issue_no`` numbers issues
    apart from them (0 for a usable path), and every issue keeps a row of its own.
    Keeping both in one relation means one scan per side. Duplicate
    paths are checked by ``reconcile`` in its own aggregate, or by ``files`` for one side.
    """

    rows: DataFrame
    side: str

    @property
    def files(self) -> DataFrame:
        """Items keyed by normalized path; a duplicate path fails the job."""
        usable = self.rows.where("NOT issue").drop("issue", "issue_no")
        usable = usable.withColumnRenamed("sort_key", "normalized_path")
        return assert_unique(
            usable, ["normalized_path"], _duplicate(self.side, "normalized_path")
        )

    @property
    def issues(self) -> DataFrame:
        """Rows outside the root or with an unsafe path."""
        issues = self.rows.where("issue").drop("issue", "issue_no")
        return issues.withColumnRenamed("display_path", "path")


def _duplicate(side: str, key: str) -> str:
    return named(f"duplicate_normalized_path in {side} inventory: ", key)


def side_inventory(listing: DataFrame, root: str, side: str) -> Inventory:
    """Files of one side by their path below ``root``: a projection of the scan.

    ``listing`` needs ``ordinal``, which numbers issues in listing order. Times are parsed
    here, once per row.
    """
    if side not in ("source", "destination"):
        raise ConfigurationError("side must be source or destination.")
    require_utc(listing.sparkSession)
    paths = relative_path("path_lower", "path_display", root)
    keyed = listing.where("entry_type = 'file'").selectExpr(
        "*", f"{paths.normalized} AS normalized", f"{paths.display} AS display"
    )
    rows = keyed.selectExpr(
        "normalized IS NULL AS issue",
        "CASE WHEN normalized IS NULL THEN monotonically_increasing_id() + 1 "
        "ELSE 0 END AS issue_no",
        f"coalesce(normalized, format_string('~invalid-{side}-%08d', ordinal)) AS sort_key",
        "CASE WHEN normalized IS NULL THEN coalesce(nullif(path_display, ''), "
        "nullif(path_lower, ''), id) ELSE display END AS display_path",
        "id AS file_id",
        "rev",
        "size",
        "content_hash",
        "client_modified IS NOT NULL AS has_client_modified",
        f"{to_instant('client_modified', 'assume_utc')} AS client_modified",
        f"{to_instant('server_modified', 'assume_utc')} AS server_modified",
    )
    return Inventory(rows, side)


_REASON = """CASE WHEN issue THEN 'invalid_relative_path'
    WHEN left IS NULL THEN 'destination_only'
    WHEN right IS NULL THEN 'source_only'
    WHEN left.content_hash IS NULL OR right.content_hash IS NULL THEN 'missing_content_hash'
    WHEN NOT (left.size <=> right.size) THEN 'size_mismatch'
    WHEN left.content_hash <> right.content_hash THEN 'content_hash_mismatch'
    ELSE 'matched' END"""
_STATUS = """CASE reason WHEN 'destination_only' THEN 'extra_destination'
    WHEN 'source_only' THEN 'missing' WHEN 'matched' THEN 'matched'
    WHEN 'missing_content_hash' THEN 'error' WHEN 'invalid_relative_path' THEN 'error'
    ELSE 'mismatched' END"""
# Compares instants; never changes the content status.
_CLIENT_MODIFIED = """CASE WHEN left IS NULL OR right IS NULL THEN 'not_comparable'
    WHEN NOT left.has_client_modified AND NOT right.has_client_modified THEN 'not_comparable'
    WHEN NOT left.has_client_modified THEN 'source_missing'
    WHEN NOT right.has_client_modified THEN 'destination_missing'
    WHEN left.client_modified IS NULL OR right.client_modified IS NULL THEN 'not_comparable'
    WHEN left.client_modified = right.client_modified THEN 'matched' ELSE 'mismatched' END"""
_CONTENT = """struct(status,
    CASE reason WHEN 'matched' THEN 'content_match' ELSE reason END AS reason)"""
# Presence of the path; a rename is never guessed from equal content.
_NAMESPACE = """struct(CASE WHEN status IN ('mismatched', 'error') THEN 'not_comparable'
    ELSE status END AS status,
    CASE WHEN status IN ('missing', 'extra_destination') THEN reason END AS reason)"""


def _side(name: str, at: str) -> str:
    """A side's item as reported, times as UTC strings; null where the side has no item."""
    fields = ", ".join(f"{name}.{c} AS {c}" for c in ("file_id", "rev", "size", "content_hash"))
    return (
        f"CASE WHEN {name} IS NOT NULL THEN struct({fields}, {at}.client AS client_modified, "
        f"{at}.server AS server_modified) END"
    )


def reconcile(source: Inventory, destination: Inventory) -> DataFrame:
    """One report row per path of either side, plus one per path issue.

    A single exchange on the path serves the comparison and both duplicate checks. The
    rows are not sorted here; ``write_report`` sorts once, at the sink.
    """
    paired = pair_by_key(source.rows, destination.rows, ["issue", "issue_no", "sort_key"])
    paired = require(
        paired,
        "issue OR (left_rows <= 1 AND right_rows <= 1)",
        f"CASE WHEN left_rows > 1 THEN {_duplicate('source', 'sort_key')} "
        f"ELSE {_duplicate('destination', 'sort_key')} END",
    )

    def times(side: str) -> str:
        client, server = f"{side}.client_modified", f"{side}.server_modified"
        return f"struct({format_utc(client)} AS client, {format_utc(server)} AS server)"

    compared = paired.selectExpr(
        "sort_key",
        "left",
        "right",
        f"{_REASON} AS reason",
        f"{_CLIENT_MODIFIED} AS modified",
        f"{times('left')} AS left_at",
        f"{times('right')} AS right_at",
    ).selectExpr("*", f"{_STATUS} AS status")
    differs = "CASE WHEN modified = 'mismatched' THEN {}.client END"
    return compared.selectExpr(
        "'file' AS type",
        "sort_key",
        "coalesce(left.display_path, right.display_path) AS path",
        "status",
        "reason",
        f"{_CONTENT} AS content",
        f"{_NAMESPACE} AS namespace",
        f"struct(struct(modified AS status, {differs.format('left_at')} AS source, "
        f"{differs.format('right_at')} AS destination) AS client_modified) AS metadata",
        f"{_side('left', 'left_at')} AS source",
        f"{_side('right', 'right_at')} AS destination",
    )


# Totals of a report; metadata mismatches are counted over all rows, errors included.
SUMMARY_COUNTERS = [
    "count(1) AS total_paths",
    *[f"count_if(status = '{s}') AS {s}" for s in STATUSES[:-1]],
    "count_if(status = 'error') AS errors",
    "count_if(metadata.client_modified.status = 'mismatched') AS client_modified",
]


def as_summary(totals: DataFrame) -> DataFrame:
    """The summary record of counted totals."""
    counted = [counter.split(" AS ")[1] for counter in SUMMARY_COUNTERS[:-1]]
    nested = "struct(client_modified) AS metadata_mismatches"
    return totals.selectExpr("'summary' AS type", *counted, nested)


def summarize(report: DataFrame) -> DataFrame:
    """Totals per status and metadata mismatches, in one pass."""
    return as_summary(report.selectExpr(*SUMMARY_COUNTERS))


def reconcile_tables(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    compare: Sequence[str],
    required: Sequence[str] = (),
) -> DataFrame:
    """The same status model for any two keyed tables: ``key, status, reason``.

    ``required`` columns must be present on both sides to compare (status ``error``);
    ``compare`` columns are tested null-safe in order and the first difference is the reason.
    """
    columns = list(dict.fromkeys([*required, *compare]))
    paired = pair_by_key(left.select(*key, *columns), right.select(*key, *columns), list(key))
    paired = unique_sides(paired, "'duplicate key'")
    rules = [("left IS NULL", "destination_only", "extra_destination"),
             ("right IS NULL", "source_only", "missing")]
    rules += [(f"left.{c} IS NULL OR right.{c} IS NULL", f"missing_{c}", "error") for c in required]
    rules += [(f"NOT (left.{c} <=> right.{c})", f"{c}_mismatch", "mismatched") for c in compare]
    cases = " ".join(
        f"WHEN {when} THEN struct('{status}' AS status, '{reason}' AS reason)"
        for when, reason, status in rules
    )
    verdict = f"CASE {cases} ELSE struct('matched' AS status, 'matched' AS reason) END"
    return paired.withColumn("verdict", F.expr(verdict)).select(*key, "verdict.*")
