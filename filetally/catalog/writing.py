"""Record validation, sinks and checkpoint gating over the benchmark tables."""

from pyspark.sql import functions as F

from filetally.catalog.registry import query
from filetally.fixtures import INSTANT, fixture, table
from filetally.operators.records import (
    missing_folders,
    releasable_checkpoints,
    validate_operations,
    validate_records,
    verify_staged,
)
from filetally.session import materialize, scratch
from filetally.sources.records import plan_writes, write_records
from filetally.sources.staged import read_staged, write_staged

# The rules in order; 1 MiB decoded size stands for the cap.
_RECORDS = r"""v AS (SELECT *, CASE
    WHEN stream <> 'documents' THEN 'unknown_stream'
    WHEN path = '' THEN 'missing_path'
    WHEN starts_with(path, '/') OR contains(path, '/../') THEN 'invalid_path'
    WHEN NOT regexp_full_match(content_base64, '[A-Za-z0-9+/]*={0,2}')
      OR length(content_base64) % 4 <> 0 THEN 'invalid_base64'
    WHEN octet_length(from_base64(content_base64)) > 1048576 THEN 'content_too_large'
    WHEN NOT regexp_full_match(sha256, '[0-9a-f]{64}') THEN 'invalid_sha256'
    WHEN sha256(from_base64(content_base64)) <> sha256 THEN 'sha256_mismatch'
    WHEN NOT regexp_full_match(modified_at, '\d{4}-\d{2}-\d{2}T.*(Z|[+-]\d{2}:\d{2})')
      OR (modified_at IS NOT NULL AND TRY_CAST(modified_at AS TIMESTAMPTZ) IS NULL)
      THEN 'invalid_modified_at' END AS error FROM fx_records)"""


def _validated(spark, sf, policy="preserve"):
    """Records landed as a table first, the way they reach the destination."""
    records = materialize(fixture(spark, sf, "fx_records"), "landed-records")
    return validate_records(
        records, "/Exports", max_mb=1, streams=["documents"], metadata_policy=policy
    )


@query(
    f"""WITH {_RECORDS} SELECT idx, error,
      CASE WHEN error IS NULL THEN concat('/Exports/', path) END AS destination_path,
      CASE WHEN error IS NULL THEN md5(from_base64(content_base64)) END AS content_md5,
      CASE WHEN error IS NULL THEN sha256 END AS sha256,
      CASE WHEN error IS NULL THEN strftime({INSTANT.format('modified_at')},
        '%Y-%m-%dT%H:%M:%SZ') END AS modified_at FROM v""",
    uses="fx_records",
)
def validated_records(spark, sf):
    rows = _validated(spark, sf)
    return rows.select(
        "idx", "error", "destination_path", F.md5("content").alias("content_md5"), "sha256",
        "modified_at",
    )


@query(
    f"""WITH {_RECORDS} SELECT coalesce(error, 'sound') AS error, count(*) AS records,
      CAST(0 AS BIGINT) AS timestamps FROM v GROUP BY ALL""",
    uses="fx_records",
)
def ignored_timestamps(spark, sf):
    """Timestamps are validated first and then dropped under the ignore policy."""
    rows = _validated(spark, sf, "ignore")
    return rows.groupBy(F.coalesce("error", F.lit("sound")).alias("error")).agg(
        F.count(F.lit(1)).alias("records"), F.count("modified_at").alias("timestamps")
    )


_SHARED = """t AS (SELECT idx, 'f/' || CAST(idx % 97 AS VARCHAR) AS path FROM v
    WHERE error IS NULL)"""


def _sound(spark, sf):
    """Sound records sent to 97 paths, so that most are superseded."""
    rows = _validated(spark, sf).where(F.col("error").isNull())
    return rows.withColumn(
        "destination_path", F.concat(F.lit("f/"), (F.col("idx") % 97).cast("string"))
    )


@query(
    f"""WITH {_RECORDS}, {_SHARED} SELECT max(t.idx) AS idx, t.path AS destination_path,
      max_by(md5(from_base64(v.content_base64)), t.idx) AS content_md5
      FROM t JOIN v USING (idx) GROUP BY t.path""",
    uses="fx_records",
)
def written_records(spark, sf):
    """Overwrite policy: the last record of a path is what the sink holds."""
    target = scratch(spark, "records")
    write_records(_sound(spark, sf), target)
    return spark.read.parquet(target).select(
        "idx", "destination_path", F.md5("content").alias("content_md5")
    )


@query(
    f"""WITH {_RECORDS}, {_SHARED}, f AS (SELECT idx, path, row_number() OVER (PARTITION BY path
        ORDER BY idx) > 1 AS dup FROM t), s AS (SELECT min(idx) AS stop FROM f WHERE dup)
      SELECT idx, path AS destination_path, CASE WHEN stop IS NULL OR idx < stop THEN 'written'
        WHEN idx = stop THEN 'conflict' ELSE 'not_reached' END AS outcome FROM f, s""",
    uses="fx_records",
)
def conflicting_writes(spark, sf):
    """Fail policy: the first record whose path is taken ends the run."""
    return plan_writes(_sound(spark, sf), policy="fail")


@query(
    f"""WITH {_RECORDS}, t AS (SELECT idx, error IS NOT NULL AS bad,
        CASE WHEN error IS NULL THEN concat('/Exports/', path) END AS path FROM v),
      f AS (SELECT *, NOT bad AND (path IN (SELECT concat('/Exports/', path) FROM fx_records
          WHERE idx % 50 = 49) OR row_number() OVER (PARTITION BY path, bad ORDER BY idx) > 1)
        AS taken FROM t),
      s AS (SELECT min(idx) AS stop FROM f WHERE bad OR taken)
      SELECT idx, path AS destination_path, CASE WHEN stop IS NULL OR idx < stop THEN 'written'
        WHEN idx > stop THEN 'not_reached' WHEN bad THEN 'invalid' ELSE 'conflict' END AS outcome
      FROM f, s""",
    uses="fx_records",
)
def writes_into_a_filled_target(spark, sf):
    """Fail policy over every record, sound or not, with paths that the target holds already."""
    held = fixture(spark, sf, "fx_records").where("idx % 50 = 49")
    existing = held.select(F.concat(F.lit("/Exports/"), "path").alias("destination_path"))
    return plan_writes(_validated(spark, sf), existing, "fail")


@query(
    """SELECT DISTINCT folder FROM (SELECT concat('/Exports/', split_part(path, '/', 1)) AS folder
        FROM fx_version_state
      UNION ALL SELECT concat('/Exports/', split_part(path, '/', 1), '/', split_part(path, '/', 2))
        FROM fx_version_state WHERE len(string_split(path, '/')) > 2
      UNION ALL SELECT concat('/Exports/', regexp_extract(path, '^([^/]+/[^/]+/[^/]+)/', 1))
        FROM fx_version_state WHERE len(string_split(path, '/')) > 3)
      WHERE folder <> '/Exports/old'""",
    uses="fx_version_state",
)
def folders_to_create(spark, sf):
    files = fixture(spark, sf, "fx_version_state").select(
        F.concat(F.lit("/Exports/"), F.col("path")).alias("destination_path")
    )
    existing = fixture(spark, sf, "fx_version_state").select(
        F.lit("/Exports/old").alias("folder")
    ).distinct()
    return missing_folders(files, existing, "/Exports")


@query(
    """SELECT doc_id AS idx, CASE WHEN doc_id % 21 = 4 THEN 'not_a_local_url'
        WHEN doc_id % 22 = 5 THEN 'staged_file_unavailable'
        WHEN doc_id % 23 = 6 THEN 'invalid_relative_path' WHEN doc_id % 24 = 7 THEN 'size_mismatch'
        WHEN doc_id % 25 = 8 THEN 'invalid_client_modified'
        WHEN doc_id % 26 = 9 THEN 'sha256_mismatch' END AS error,
      CASE WHEN doc_id % 21 <> 4 AND doc_id % 22 <> 5 AND doc_id % 23 <> 6 AND doc_id % 24 <> 7
        AND doc_id % 25 <> 8 AND doc_id % 26 <> 9
        THEN concat('/Exports/a/', doc_id) END AS destination_path FROM documents"""
)
def verified_staged_files(spark, sf):
    """File references against staged files: URL, presence, path, size, time, digest.

    Every document is staged as a file. The check lists them by name and length, and reads in
    pieces those whose references give a digest.
    """
    number = F.col("doc_id")
    folder = scratch(spark, "staged-documents")
    documents = table(spark, sf, "documents").select("doc_id", "text")
    lines = documents.where(number % 22 != 5).select(
        F.concat(F.lit("doc_id="), number, F.lit(".txt")).alias("name"),
        F.encode(F.concat(F.coalesce("text", F.lit("")), F.lit("\n")), "UTF-8").alias("content"),
    )
    write_staged(lines, folder)
    staged = materialize(
        read_staged(spark, folder, pattern="doc_id=*.txt", content=False), "staged-listing"
    )
    places = staged.select(
        F.regexp_extract("path", r"doc_id=([0-9]+)\.txt$", 1).cast("long").alias("staged_id"),
        "path",
    )
    content = F.concat("text", F.lit("\n"))
    # Taken next to the text, which is not joined.
    facts = documents.select(
        number,
        F.octet_length(content).cast("long").alias("bytes"),
        F.sha2(F.encode(content, "UTF-8"), 256).alias("digest"),
    )
    place = F.coalesce(
        F.replace("path", F.lit("="), F.lit("%3D")), F.concat(F.lit("/nowhere/"), number)
    )
    refs = facts.join(places, F.col("staged_id") == number, "left").select(
        number.alias("idx"),
        F.concat(
            F.when(number % 21 == 4, F.lit("https://host")).otherwise(F.lit("file://")), place
        ).alias("staging_file_url"),
        F.concat(F.when(number % 23 == 6, F.lit("a/../")).otherwise(F.lit("a/")), number).alias(
            "relative_path"
        ),
        (F.col("bytes") + F.when(number % 24 == 7, 1).otherwise(0)).alias("file_size_bytes"),
        F.when(number % 26 == 9, F.sha2(F.encode(F.lit("x"), "UTF-8"), 256))
        .otherwise(F.col("digest"))
        .alias("sha256"),
        F.when(number % 25 == 8, F.lit("yesterday")).otherwise(
            F.lit("2026-08-18T12:00:00Z")
        ).alias("client_modified"),
    )
    # Written once, because the check reads its references twice.
    refs = materialize(refs, "staged-references")
    return verify_staged(refs, staged, "/Exports").select("idx", "error", "destination_path")


@query(
    """SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey,
      CAST(octet_length(encode(n_name)) + 1 AS BIGINT) AS length, sha256(n_name || chr(10)) AS sha256
    FROM nation"""
)
def staged_files(spark, sf):
    """Every nation's name staged as a file of its own, with size and digest."""
    folder = scratch(spark, "staged")
    names = spark.read.parquet(f"{sf}/nation.parquet").select("n_nationkey", "n_name")
    names.write.partitionBy("n_nationkey").text(folder)
    files = read_staged(spark, folder, pattern="part-*.txt")
    return files.select(
        F.regexp_extract("path", "n_nationkey=([0-9]+)/", 1).cast("long").alias("n_nationkey"),
        "length",
        F.sha2("content", 256).alias("sha256"),
    )


@query(
    """SELECT idx, CASE WHEN idx % 31 = 5 THEN 'invalid_operation'
        WHEN idx % 32 = 6 THEN 'invalid_old_path' WHEN idx % 33 = 7 THEN 'missing_old_content_hash'
        WHEN operation = 'move' AND idx % 34 = 8 THEN 'missing_new_path' END AS error
      FROM fx_operations""",
    uses="fx_operations",
)
def validated_operations(spark, sf):
    n = F.col("idx")
    ops = fixture(spark, sf, "fx_operations").withColumns(
        {
            "operation": F.when(n % 31 == 5, F.lit("copy")).otherwise(F.col("operation")),
            "old_path": F.when(n % 32 == 6, F.concat(F.lit("../"), F.col("old_path"))).otherwise(
                F.col("old_path")
            ),
            "old_content_hash": F.when(n % 33 == 7, F.lit("")).otherwise(
                F.col("old_content_hash")
            ),
            "new_path": F.when(n % 34 != 8, F.col("new_path")),
        }
    )
    return validate_operations(ops).select("idx", "error")


_GATE = """SELECT run, idx, path, released FROM (SELECT *, coalesce(bool_or(failed AND kind = 'record')
        OVER (PARTITION BY run ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        false) = false AS released FROM fx_write_log) WHERE kind = 'state'"""


@query(_GATE, uses="fx_write_log")
def checkpoint_gate(spark, sf):
    return releasable_checkpoints(fixture(spark, sf, "fx_write_log")).select(
        "run", "idx", "path", "released"
    )
