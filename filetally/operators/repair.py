"""Repair planning from a reconciliation report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.functions.paths import fold, is_safe_relative, target_path
from filetally.guards import non_empty, quoted, require_empty
from filetally.operators.keyed import dedupe_strict, duplicate_keys
from filetally.operators.reconcile import STATUSES

ACTIONABLE = ("missing", "mismatched")
_ACTS = f"status IN ({quoted(ACTIONABLE)})"
# First broken row rule of a report record, null if it is sound.
_VIOLATION = f"""CASE WHEN NOT {is_safe_relative('path')} THEN 'invalid_relative_path'
    WHEN NOT coalesce(status IN ({quoted(STATUSES)}), false) THEN 'unknown_status'
    WHEN NOT {_ACTS} THEN NULL
    WHEN source IS NULL THEN 'missing_source'
    WHEN NOT {non_empty('source.file_id')} THEN 'invalid_file_id'
    WHEN NOT {non_empty('source.rev')} THEN 'invalid_rev'
    WHEN NOT {non_empty('source.content_hash')} THEN 'invalid_content_hash'
    WHEN NOT coalesce(source.size >= 0, false) THEN 'invalid_size' END"""


def report_violations(details: DataFrame) -> DataFrame:
    """``rule, rows`` for every broken rule: row rules first, then paths equal under folding."""
    by_row = (
        details.selectExpr(f"{_VIOLATION} AS rule")
        .where("rule IS NOT NULL")
        .groupBy("rule")
        .agg(F.expr("count(1) AS rows"))
    )
    copies = duplicate_keys(details.selectExpr(f"{fold('path')} AS folded"), ["folded"])
    repeated = copies.selectExpr("'duplicate_path' AS rule", "sum(copies) AS rows")
    return by_row.unionByName(repeated.where("rows IS NOT NULL"))


def validate_report(details: DataFrame) -> DataFrame:
    """Check the whole report before anything acts on it; return it unchanged."""
    require_empty(report_violations(details), "Report breaks a rule; no repair was planned.")
    return details


def repair_actions(details: DataFrame) -> DataFrame:
    """Report rows plus ``actionable``: missing and mismatched act, the rest is skipped."""
    return details.withColumn("actionable", F.expr(_ACTS))


def check_drift(actions: DataFrame, current: DataFrame, root: str) -> DataFrame:
    """Mark actionable rows whose source changed since the report (``drifted``).

    ``current`` is the present source listing, one row per file id. Only acting rows are
    joined; the others pass by, so rows without a source never meet in one task.
    """
    listed = current.where("entry_type = 'file'").selectExpr(
        "id AS file_id", "struct(rev, size, content_hash, path_lower) AS now"
    )
    listed = dedupe_strict(listed, ["file_id"], "'conflicting rows of a file in the listing'")
    acting = actions.where("actionable").withColumn("file_id", F.expr("source.file_id"))
    expected = fold(target_path(root, "path"))
    drifted = f"""now IS NULL OR NOT (now <=> struct(source.rev AS rev, source.size AS size,
        source.content_hash AS content_hash, {expected} AS path_lower))"""
    checked = acting.join(listed, "file_id", "left").withColumn("drifted", F.expr(drifted))
    return checked.drop("file_id", "now").unionByName(
        actions.where("NOT actionable").withColumn("drifted", F.lit(False))
    )


def repair_outcomes(checked: DataFrame) -> DataFrame:
    """``path, action, source_status``; a drifted row is an error and stops no other row."""
    return checked.selectExpr(
        "path",
        "CASE WHEN NOT actionable THEN 'skipped' WHEN drifted THEN 'error' "
        "WHEN status = 'missing' THEN 'uploaded' ELSE 'overwritten' END AS action",
        "status AS source_status",
    )


def repair_summary(outcomes: DataFrame) -> DataFrame:
    return outcomes.selectExpr(
        "'summary' AS type",
        "count_if(action = 'uploaded') AS uploaded",
        "count_if(action = 'overwritten') AS overwritten",
        "count_if(action = 'skipped') AS skipped",
        "count_if(action = 'error') AS errors",
    )
