"""Validation of file records, staged files and control records, and checkpoint gating."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.errors import ConfigurationError
from filetally.functions.paths import ancestors, is_safe_relative, parent, target_path
from filetally.functions.times import RFC3339, format_utc, has_offset, to_instant
from filetally.guards import non_empty, quote, quoted, require_empty
from filetally.session import require_utc
from filetally.sources.staged import file_digests

METADATA_POLICIES = ("preserve", "ignore")
LARGEST_RECORD_MB = 64
MEBIBYTE = 1024 * 1024
# Alphabet, then at most two pads; with a length that is a multiple of four this is strict.
BASE64 = r"\A[A-Za-z0-9+/]*={0,2}\z"
SHA256 = r"\A[0-9a-f]{64}\z"


def _policy(policy: str) -> str:
    if policy not in METADATA_POLICIES:
        raise ConfigurationError(f"metadata policy {policy!r} is none of {METADATA_POLICIES}.")
    return policy


def _first_broken(rules: Sequence[tuple[str, str]]) -> str:
    """SQL for the name of the first rule whose condition is true; null if none is."""
    return "CASE " + " ".join(f"WHEN {broken} THEN '{name}'" for broken, name in rules) + " END"


def _not(condition: str) -> str:
    """True where ``condition`` is false or null."""
    return f"NOT coalesce({condition}, false)"


def _kept_time(column: str, policy: str) -> str:
    """The UTC time of a sound row under the metadata policy."""
    if policy == "ignore":
        return "CAST(NULL AS STRING)"
    return f"CASE WHEN error IS NULL THEN {format_utc(to_instant(column, 'null'))} END"


def validate_records(
    df: DataFrame,
    root: str,
    max_mb: int = 10,
    streams: Sequence[str] | None = None,
    metadata_policy: str = "preserve",
    fail_closed: bool = False,
) -> DataFrame:
    """Apply the record rules in order; ``error`` names the first broken one.

    Sound records get ``destination_path``, decoded ``content``, ``sha256`` and the UTC
    ``modified_at``. Size is derived from the encoded length, so oversized content is
    never decoded; the digest is computed only where one was supplied. Errors name rules and
    never echo content. ``fail_closed`` raises if any record is unsound.
    """
    if isinstance(max_mb, bool) or not isinstance(max_mb, int) or not (
        1 <= max_mb <= LARGEST_RECORD_MB
    ):
        raise ConfigurationError(f"max_mb must be between 1 and {LARGEST_RECORD_MB}.")
    _policy(metadata_policy)
    require_utc(df.sparkSession)
    strict = f"content_base64 RLIKE {quote(BASE64)} AND length(content_base64) % 4 = 0"
    pads = (
        "CASE WHEN endswith(content_base64, '==') THEN 2 "
        "WHEN endswith(content_base64, '=') THEN 1 ELSE 0 END"
    )
    size = f"length(content_base64) div 4 * 3 - {pads}"
    rules = [
        (f"NOT {non_empty('path')}", "missing_path"),
        (f"NOT {is_safe_relative('path')}", "invalid_path"),
        (f"NOT {non_empty('content_base64')}", "missing_content"),
        (_not(strict), "invalid_base64"),
        (f"{size} > {max_mb * MEBIBYTE}", "content_too_large"),
        (f"sha256 IS NOT NULL AND {_not(f'sha256 RLIKE {quote(SHA256)}')}", "invalid_sha256"),
        ("sha2(unbase64(content_base64), 256) <> sha256", "sha256_mismatch"),
        (f"NOT (modified_at RLIKE {quote(RFC3339)})", "invalid_modified_at"),
        (f"modified_at IS NOT NULL AND {to_instant('modified_at', 'null')} IS NULL",
         "invalid_modified_at"),
    ]
    if streams is not None:
        rules.insert(0, (_not(f"stream IN ({quoted(streams)})"), "unknown_stream"))
    checked = df.withColumn("error", F.expr(_first_broken(rules)))
    if fail_closed:
        bad = checked.where("error IS NOT NULL").select("error")
        require_empty(bad, "A file record breaks the contract.")
    made = ("path", "content_base64", "sha256", "modified_at")
    return checked.selectExpr(
        *[c for c in df.columns if c not in made],
        "error",
        f"CASE WHEN error IS NULL THEN {target_path(root, 'path')} END AS destination_path",
        "CASE WHEN error IS NULL THEN unbase64(content_base64) END AS content",
        "CASE WHEN error IS NULL THEN sha256 END AS sha256",
        f"{_kept_time('modified_at', metadata_policy)} AS modified_at",
    )


def missing_folders(
    paths: DataFrame, existing: DataFrame, root: str, column: str = "destination_path"
) -> DataFrame:
    """Folders below ``root`` to create for absolute file paths, each once.

    Paths are first reduced to their distinct parents, so the explode grows with folders
    and not with files.
    """
    parents = paths.selectExpr(f"concat({parent(column)}, '/-') AS inside").distinct()
    needed = parents.selectExpr(f"explode({ancestors('inside', root)}) AS folder").distinct()
    return needed.join(existing.select("folder"), "folder", "left_anti")


# No scheme and no host, or a file URL without host or with localhost.
_LOCAL = r"^(?![A-Za-z][A-Za-z0-9+.-]*:|//)|^file:(///|//localhost/|/(?!/))"
# Percent-decoded path of such a URL; '+' is literal in a path but a space to the decoder.
_LOCATION = """coalesce(try_url_decode(replace(regexp_replace(
    staging_file_url, '^file:(//(localhost)?)?(?=/)', ''), '+', '%2B')), staging_file_url)"""


def verify_staged(
    refs: DataFrame, staged: DataFrame, root: str, metadata_policy: str = "preserve"
) -> DataFrame:
    """Check file references against staged files; ``error`` names the first broken rule.

    ``staged`` lists paths and lengths. Digests are needed of the present files whose references
    give one, and only these are read, piece by piece. If ``staged`` brings ``content``, the
    digests are computed next to the bytes instead. A digest that is not 64 characters long is
    ignored.
    """
    _policy(metadata_policy)
    require_utc(refs.sparkSession)
    given = "coalesce(length(sha256) = 64, false)"
    found = staged.selectExpr("path AS location", "struct(length) AS staged")
    located = refs.withColumn("location", F.expr(_LOCATION)).join(found, "location", "left")
    named = located.where(given).select("location").distinct()
    if "content" in staged.columns:
        inside = staged.withColumnRenamed("path", "location").join(named, "location", "left_semi")
        digests = inside.selectExpr("location", "struct(sha2(content, 256) AS digest) AS read")
    else:
        present = named.join(found, "location", "left_semi").withColumnRenamed("location", "path")
        digests = file_digests(present).selectExpr("path AS location", "struct(digest) AS read")
    joined = located.join(digests, "location", "left")
    rules = [
        (f"NOT {non_empty('staging_file_url')}", "missing_staging_url"),
        (f"NOT (staging_file_url RLIKE {quote(_LOCAL)})", "not_a_local_url"),
        ("staged IS NULL", "staged_file_unavailable"),
        (f"NOT {non_empty('relative_path')}", "missing_relative_path"),
        (f"NOT {is_safe_relative('relative_path')}", "invalid_relative_path"),
        (_not("file_size_bytes >= 0"), "invalid_size"),
        ("staged.length <> file_size_bytes", "size_mismatch"),
        (f"{given} AND read.digest IS NULL", "digest_unavailable"),
        (f"{given} AND {_not('read.digest = sha256')}", "sha256_mismatch"),
    ]
    if metadata_policy == "preserve":
        unusable = (
            f"client_modified IS NOT NULL AND (NOT {has_offset('client_modified')} "
            f"OR {to_instant('client_modified', 'null')} IS NULL)"
        )
        rules.insert(-2, (unusable, "invalid_client_modified"))
    checked = joined.withColumn("error", F.expr(_first_broken(rules)))
    return checked.selectExpr(
        *[c for c in refs.columns if c not in ("sha256", "client_modified")],
        "error",
        f"CASE WHEN error IS NULL THEN {target_path(root, 'relative_path')} END "
        "AS destination_path",
        f"CASE WHEN error IS NULL AND {given} THEN sha256 END AS sha256",
        f"{_kept_time('client_modified', metadata_policy)} AS client_modified",
    )


def validate_operations(df: DataFrame) -> DataFrame:
    """Control records plus ``error``: kind, required strings, safe paths."""
    moves = "operation = 'move' AND"
    rules = [
        (_not("operation IN ('move', 'delete')"), "invalid_operation"),
        (f"NOT {non_empty('file_id')}", "missing_file_id"),
        (f"NOT {non_empty('old_path')}", "missing_old_path"),
        (f"NOT {is_safe_relative('old_path')}", "invalid_old_path"),
        (f"NOT {non_empty('old_content_hash')}", "missing_old_content_hash"),
        (f"{moves} NOT {non_empty('new_path')}", "missing_new_path"),
        (f"{moves} NOT {is_safe_relative('new_path')}", "invalid_new_path"),
        (f"{moves} NOT {non_empty('new_content_hash')}", "missing_new_content_hash"),
    ]
    return df.withColumn("error", F.expr(_first_broken(rules)))


def releasable_checkpoints(log: DataFrame) -> DataFrame:
    """State messages of each run plus ``released``: did every earlier record succeed?

    ``log`` has ``run, idx, kind, failed``. The first failing index per run decides, which
    is one partial aggregate; a running window would put a whole run in one task.
    """
    failures = (
        log.where("kind = 'record' AND failed")
        .groupBy("run")
        .agg(F.min("idx").alias("first_failure"))
    )
    released = F.expr("first_failure IS NULL OR idx < first_failure")
    return (
        log.where("kind = 'state'")
        .join(failures, "run", "left")
        .withColumn("released", released)
        .drop("first_failure")
    )
