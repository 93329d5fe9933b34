"""Check what a transfer delivered and turn it into records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.functions.times import format_utc, last_modified, to_utc
from filetally.operators.keyed import dedupe_strict
from filetally.session import require_utc


def transfer_records(transfers: DataFrame, staged: DataFrame) -> DataFrame:
    """Planned transfers with ``outcome`` and, when delivered, digest and provenance.

    ``transfers`` is a plan's transfer list joined to the listing's provenance columns
    (``path_lower, path_display, client_modified, server_modified``); ``staged`` holds
    ``file_id, rev, content``. A file that vanished, changed revision, or has another byte
    count is skipped. Digest and length are taken before the join, so bytes never shuffle;
    equal staged rows of a file count once, differing ones fail the job.
    """
    require_utc(transfers.sparkSession)
    delivered = staged.selectExpr(
        "file_id",
        "struct(rev, CAST(octet_length(content) AS BIGINT) AS bytes, "
        "sha2(content, 256) AS digest) AS got",
    )
    outcome = """CASE WHEN got.bytes IS NULL THEN 'skipped_unavailable'
        WHEN NOT (got.rev <=> rev) THEN 'skipped_changed'
        WHEN NOT (got.bytes <=> size) THEN 'skipped_byte_count' ELSE 'transferred' END"""
    delivered = dedupe_strict(delivered, ["file_id"], "'conflicting staged files'")
    joined = transfers.join(delivered, "file_id", "left")
    return joined.withColumn("outcome", F.expr(outcome)).selectExpr(
        "file_id",
        "path AS relative_path",
        "path_lower",
        "path_display",
        "rev",
        "content_hash",
        "size",
        "CASE WHEN outcome = 'transferred' THEN got.digest END AS sha256",
        f"{to_utc('client_modified')} AS client_modified",
        f"{to_utc('server_modified')} AS server_modified",
        f"{format_utc(last_modified('server_modified', 'client_modified'))} AS last_modified",
        "outcome",
    )
