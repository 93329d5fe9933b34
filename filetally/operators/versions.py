"""Change detection by byte version, and document extraction driven by it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.errors import ConfigurationError
from filetally.functions.paths import extension
from filetally.functions.times import to_utc
from filetally.guards import fails, non_empty, passes, quoted
from filetally.operators.keyed import dedupe_strict
from filetally.schemas import CONTRACTS, EXTRACTION_STATE
from filetally.session import require_utc

# Suffixes that can be converted to Markdown.
MARKDOWN_SUFFIXES = (
    ".binder",
    ".docx",
    ".gsheet",
    ".html",
    ".ods",
    ".paper",
    ".papert",
    ".pdf",
    ".pptx",
    ".xlsx",
)
# What a document itself can cause, and what points at the service.
FILE_ERRORS = (
    "unsupported_format_error",
    "limit_exceeded_error",
    "conversion_failure_error",
    "not_found_error",
    "is_a_folder_error",
    "user_error",
)
SYSTEMIC_CODES = (
    "access_error",
    "ratelimit_error",
    "unavailable",
    "api_error",
    "bad_request",
    "unknown_error",
    "other",
)
MODES = ("incremental", "full_refresh")
MEBIBYTE = 1024 * 1024


def with_transferable(df: DataFrame, max_mb: int) -> DataFrame:
    """Mark, never drop, files above the cap: an oversized file still counts as present."""
    return df.withColumn("transferable", F.expr(f"size <= {max_mb * MEBIBYTE}"))


def classify(current: DataFrame, state: DataFrame) -> DataFrame:
    """``current`` plus ``change``: new, changed or unchanged; a rename alone is unchanged."""
    known = state.selectExpr("file_id", "struct(rev, content_hash) AS prior")
    change = """CASE WHEN prior IS NULL THEN 'new'
        WHEN NOT (struct(rev, content_hash) <=> prior) THEN 'changed' ELSE 'unchanged' END"""
    joined = current.join(known, "file_id", "left")
    return joined.withColumn("change", F.expr(change)).drop("prior")


def allowed_suffixes(suffixes: list[str]) -> list[str]:
    wanted = sorted({s.lower() for s in suffixes})
    if not wanted:
        raise ConfigurationError("at least one extension must be allowed.")
    unknown = [s for s in wanted if s not in MARKDOWN_SUFFIXES]
    if unknown:
        raise ConfigurationError(f"unsupported extension(s): {', '.join(unknown)}.")
    return wanted


def extraction_bounds(max_mb: int = 10, timeout_seconds: int = 300) -> int:
    """Check both bounds and return the size cap in bytes."""
    if isinstance(max_mb, bool) or not isinstance(max_mb, int) or not 1 <= max_mb <= 50:
        raise ConfigurationError("max_mb takes a whole number from 1 to 50.")
    if not isinstance(timeout_seconds, int) or not 10 <= timeout_seconds <= 600:
        raise ConfigurationError("timeout_seconds takes a whole number from 10 to 600.")
    return max_mb * MEBIBYTE


def skipped_documents(files: DataFrame, suffixes: list[str], max_mb: int = 10) -> DataFrame:
    """An account of convertible files over the size cap: ``file_id, name, size, reason``.

    Files of other suffixes are no documents and not listed.
    """
    cap = extraction_bounds(max_mb)
    wanted = f"{extension('name')} IN ({quoted(allowed_suffixes(suffixes))})"
    return files.where(wanted).where(f"NOT coalesce(size <= {cap}, false)").selectExpr(
        "file_id", "name", "size", "'too_large' AS reason"
    )


def extraction_candidates(
    files: DataFrame,
    state: DataFrame | None,
    suffixes: list[str],
    max_mb: int = 10,
    mode: str = "incremental",
) -> DataFrame:
    """Eligible files whose version has no result yet; a full refresh ignores the state.

    Expects ``file_id, rev, content_hash, name, size`` among the columns. The cheap tests
    run before the anti join, and an eligible file without identity fails the job.
    """
    if mode not in MODES:
        raise ConfigurationError("mode must be incremental or full_refresh.")
    cap = extraction_bounds(max_mb)
    eligible = f"{extension('name')} IN ({quoted(allowed_suffixes(suffixes))})"
    identified = passes(
        non_empty("file_id", "rev", "content_hash"),
        "'An eligible file has no stable id, rev or content hash.'",
    )
    chosen = files.where(f"size <= {cap} AND {eligible}").where(identified)
    if mode == "full_refresh" or state is None:
        return chosen
    key = ["file_id", "rev", "content_hash"]
    return chosen.join(state.select(*key), key, "left_anti")


def file_contents(candidates: DataFrame, results: DataFrame) -> DataFrame:
    """Records for candidates with an outcome; systemic failures fail the job.

    ``results`` carries a poll status per version: ``succeeded`` (or ``complete``),
    ``failed``, ``timed_out``, or ``other`` for a status the service does not explain. Equal
    results of a version count once; differing ones fail the job.
    """
    require_utc(candidates.sparkSession)
    key = ["file_id", "rev", "content_hash"]
    outcome = results.selectExpr(
        *key,
        "struct(CASE status WHEN 'complete' THEN 'succeeded' ELSE status END AS status, "
        "markdown, error_type AS type, error_code AS code, error_message AS message) AS r",
    )
    no_markdown = passes("r.markdown IS NOT NULL", "'A successful extraction has no Markdown.'")
    systemic = fails("concat('Extraction failed with systemic error ', r.code)")
    valid = f"""CASE
        WHEN r.status = 'succeeded' THEN {no_markdown}
        WHEN r.status IN ('timed_out', 'other') THEN true
        WHEN r.status = 'failed' AND r.type IN ({quoted(FILE_ERRORS)}) THEN true
        WHEN r.status = 'failed' AND r.code IN ({quoted(SYSTEMIC_CODES)}) THEN {systemic}
        ELSE {fails("'Unexpected extraction outcome.'")} END"""
    made = {
        "client_modified": to_utc("client_modified"),
        "server_modified": to_utc("server_modified"),
        "content_format": "'markdown'",
        "markdown": "CASE WHEN r.status = 'succeeded' THEN r.markdown END",
        "extraction_status": "CASE r.status WHEN 'other' THEN 'failed' ELSE r.status END",
        "error_type": "CASE r.status WHEN 'failed' THEN r.type WHEN 'timed_out' THEN 'timeout' "
        "WHEN 'other' THEN 'unknown_status' END",
        "error_code": "CASE WHEN r.status = 'failed' THEN r.code END",
        "error_details": "CASE WHEN r.status = 'failed' THEN struct(r.type AS type, "
        "CASE WHEN r.type = 'user_error' THEN r.message END AS message) END",
        "error_message": "CASE r.status WHEN 'failed' THEN CASE WHEN r.type = 'user_error' "
        "AND r.message IS NOT NULL THEN r.message "
        "ELSE concat('Extraction failed: ', r.type, '.') END "
        "WHEN 'timed_out' THEN coalesce(r.message, 'Extraction timed out.') "
        "WHEN 'other' THEN 'Extraction returned an unknown status.' END",
    }
    columns = CONTRACTS["file_contents"].schema.names
    return (
        candidates.join(dedupe_strict(outcome, key, "'conflicting extraction results'"), key)
        .where(valid)
        .selectExpr(*[f"{made[c]} AS {c}" if c in made else c for c in columns])
    )


def settled_versions(records: DataFrame) -> DataFrame:
    """State rows of succeeded and failed records; timed-out files stay due."""
    return records.where("extraction_status IN ('succeeded', 'failed')").selectExpr(
        "file_id", "rev", "content_hash", "path_lower AS path"
    )


def advance_extraction_state(state: DataFrame, records: DataFrame) -> DataFrame:
    """The whole next state. It only grows: a vanished file keeps its last version."""
    settled = settled_versions(records)
    kept = state.join(settled.select("file_id"), "file_id", "left_anti")
    return kept.select(*EXTRACTION_STATE.names).unionByName(settled)
