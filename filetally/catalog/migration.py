"""Version classification, extraction and migration planning over the benchmark tables."""

from dataclasses import replace

from pyspark.sql import functions as F

from filetally.catalog.registry import file_listing, query
from filetally.fixtures import fixture, table
from filetally.operators import warehouse
from filetally.operators.versions import (
    advance_extraction_state,
    classify,
    extraction_candidates,
    file_contents,
)
from filetally.plans import (
    apply_operations,
    migration_inventory,
    next_state,
    plan_delta,
    plan_snapshot,
    transfer_records,
)
from filetally.session import scratch
from filetally.sources.keyed_state import KeyedState
from filetally.sources.state import Scope, State, read_state, write_state

SCOPE = Scope("/Source-Root", True)
PLANNED = "fx_source fx_version_state"
SUFFIXES = [".pdf", ".docx", ".HTML"]

# Current files at their transfer path, joined to the stored versions.
_PAIRED = """c AS (SELECT *, CASE WHEN starts_with(path_display, '/Source-Root/')
      THEN substr(path_display, 14) ELSE ltrim(path_display, '/') END AS path FROM fx_source),
  p AS (SELECT coalesce(c.file_id, v.file_id) AS file_id, c.path AS now_path,
      c.rev AS now_rev, c.content_hash AS now_hash, c.size AS size, v.path AS old_path,
      v.content_hash AS old_hash, c.file_id IS NULL AS gone, v.file_id IS NULL AS fresh,
      c.path <> v.path AS renamed, c.rev <> v.rev OR c.content_hash <> v.content_hash AS changed
    FROM c FULL OUTER JOIN fx_version_state v USING (file_id))"""
_OPERATIONS = """SELECT CASE WHEN gone THEN 1 ELSE 0 END AS phase,
    CASE WHEN gone THEN 'delete' ELSE 'move' END AS operation, file_id, old_path,
    old_hash AS old_content_hash, now_path AS new_path, now_hash AS new_content_hash
  FROM p WHERE gone OR renamed"""
_TRANSFERS = """SELECT file_id, CASE WHEN fresh THEN now_path WHEN {moves} THEN now_path
    ELSE old_path END AS path, now_rev AS rev, now_hash AS content_hash, size
  FROM p WHERE NOT gone AND (fresh OR changed)"""


def _state(spark, sf):
    files = fixture(spark, sf, "fx_version_state")
    return State(files, SCOPE, "cursor-1")


def _snapshot(spark, sf, rename, delete):
    inventory = migration_inventory(file_listing(spark, sf, "fx_source"), "/Source-Root")
    return plan_snapshot(
        inventory, _state(spark, sf), scope=SCOPE, rename_policy=rename, delete_policy=delete
    )


@query(
    """SELECT s.file_id, CASE WHEN v.file_id IS NULL THEN 'new'
        WHEN s.rev <> v.rev OR s.content_hash <> v.content_hash THEN 'changed'
        ELSE 'unchanged' END AS change
      FROM fx_source s LEFT JOIN fx_version_state v USING (file_id)""",
    uses=PLANNED,
)
def version_changes(spark, sf):
    current = fixture(spark, sf, "fx_source").select("file_id", "rev", "content_hash")
    return classify(current, fixture(spark, sf, "fx_version_state")).select("file_id", "change")


@query(f"WITH {_PAIRED} {_OPERATIONS}", uses=PLANNED)
def snapshot_operations(spark, sf):
    return _snapshot(spark, sf, "propagate", "delete").operations


@query(f"WITH {_PAIRED} {_TRANSFERS.format(moves='renamed')}", uses=PLANNED)
def snapshot_transfers(spark, sf):
    return _snapshot(spark, sf, "propagate", "delete").transfers.drop("phase")


@query(f"WITH {_PAIRED} {_TRANSFERS.format(moves='false')}", uses=PLANNED)
def pinned_transfers(spark, sf):
    """Renames ignored: changed bytes go to the stored path."""
    return _snapshot(spark, sf, "ignore", "ignore").transfers.drop("phase")


def _delta(spark, sf, rename):
    changed = migration_inventory(file_listing(spark, sf, "fx_source"), "/Source-Root").drop(
        "ordinal"
    )
    return plan_delta(
        changed, fixture(spark, sf, "fx_tombstones"), _state(spark, sf), scope=SCOPE,
        rename_policy=rename, delete_policy="delete",
    )


_DELETES = """x AS (SELECT DISTINCT lower(path) AS k FROM fx_tombstones WHERE lower(path) NOT IN
    (SELECT lower(old_path) FROM p WHERE renamed)),
  dead AS (SELECT max_by(v.file_id, v.file_id) AS file_id, max_by(v.path, v.file_id) AS old_path,
      max_by(v.content_hash, v.file_id) AS old_content_hash
    FROM fx_version_state v JOIN x ON lower(v.path) = x.k GROUP BY x.k)"""
_DELTA = f"{PLANNED} fx_tombstones"


@query(
    f"""WITH {_PAIRED}, {_DELETES}
      SELECT 0 AS phase, 'move' AS operation, file_id, old_path, old_hash AS old_content_hash,
        now_path AS new_path, now_hash AS new_content_hash FROM p WHERE renamed
      UNION ALL SELECT 1, 'delete', file_id, old_path, old_content_hash, NULL, NULL FROM dead""",
    uses=_DELTA,
)
def delta_operations(spark, sf):
    return _delta(spark, sf, "propagate").operations


@query(
    f"""WITH {_PAIRED}, {_DELETES}
      SELECT 0 AS phase, 'move' AS operation, file_id, old_path, old_hash AS old_content_hash,
        now_path AS new_path, now_hash AS new_content_hash FROM p WHERE renamed
      UNION ALL SELECT 1, 'delete', file_id, old_path, old_content_hash, NULL, NULL FROM dead""",
    uses=_DELTA,
)
def keyed_delta_operations(spark, sf):
    """The delta planned from a state in buckets, of which it reads those that it names."""
    state = _state(spark, sf)
    keyed = KeyedState(scratch(spark, "keyed-state"))
    keyed.merge(state.files.withColumn("removed", F.lit(False)), 0)
    changed = migration_inventory(file_listing(spark, sf, "fx_source"), "/Source-Root").drop(
        "ordinal"
    )
    tombstones = fixture(spark, sf, "fx_tombstones")
    return plan_delta(
        changed, tombstones, replace(state, files=keyed.named(changed, tombstones)), scope=SCOPE,
        rename_policy="propagate", delete_policy="delete",
    ).operations


@query(f"WITH {_PAIRED} {_TRANSFERS.format(moves='false')}", uses=PLANNED)
def delta_transfers(spark, sf):
    return _delta(spark, sf, "ignore").transfers.drop("phase")


@query(
    f"""WITH {_PAIRED} SELECT file_id, CASE WHEN fresh OR renamed THEN now_path
        ELSE old_path END AS path, CASE WHEN fresh OR changed THEN now_rev ELSE v.rev END AS rev,
        CASE WHEN fresh OR changed THEN now_hash ELSE old_hash END AS content_hash
      FROM p LEFT JOIN fx_version_state v USING (file_id) WHERE NOT gone""",
    uses=PLANNED,
)
def folded_state(spark, sf):
    """The state after the whole snapshot plan took effect."""
    plan = _snapshot(spark, sf, "propagate", "delete")
    return next_state(plan.state.files, plan.operations, plan.transfers)


@query("SELECT file_id, path, rev, content_hash FROM fx_version_state", uses="fx_version_state")
def stored_state(spark, sf):
    """Written as a committed version and read back."""
    path = scratch(spark, "state")
    write_state(_state(spark, sf), path, version=0)
    return read_state(spark, path).files


@query(
    """SELECT file_id, CASE WHEN doc_id % 25 = 4 THEN 'skipped_unavailable'
        WHEN doc_id % 30 = 7 THEN 'skipped_changed'
        WHEN octet_length(encode(text)) <> n_chars THEN 'skipped_byte_count'
        ELSE 'transferred' END AS outcome,
      CASE WHEN doc_id % 25 <> 4 AND doc_id % 30 <> 7
        AND octet_length(encode(text)) = n_chars THEN sha256(text) END AS sha256,
      strftime(TRY_CAST(client_modified AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ') AS client_modified,
      strftime(coalesce(TRY_CAST(client_modified AS TIMESTAMP), TIMESTAMP '1970-01-01'),
        '%Y-%m-%dT%H:%M:%SZ') AS last_modified
      FROM fx_source s JOIN documents d ON d.doc_id = s.ordinal""",
    uses="fx_source",
)
def transfer_outcomes(spark, sf):
    listing = file_listing(spark, sf, "fx_source")
    files = migration_inventory(listing, "/Source-Root").drop("transferable", "ordinal")
    provenance = listing.select(
        F.col("id").alias("file_id"), "path_lower", "path_display", "client_modified",
        "server_modified",
    )
    number = F.col("doc_id")
    staged = table(spark, sf, "documents").where(number % 25 != 4).select(
        F.concat(F.lit("id:"), number).alias("file_id"),
        F.when(number % 30 == 7, F.lit("r-new"))
        .otherwise(F.concat(F.lit("r"), number % 7))
        .alias("rev"),
        F.encode("text", "UTF-8").alias("content"),
    )
    return transfer_records(files.join(provenance, "file_id"), staged).select(
        "file_id", "outcome", "sha256", "client_modified", "last_modified"
    )


_ELIGIBLE = """e AS (SELECT * FROM fx_source
    WHERE lower(regexp_extract(name, '([.][^.]+)$', 1)) IN ('.pdf', '.docx', '.html')
      AND size <= 1048576)"""


def _extraction_files(spark, sf):
    return fixture(spark, sf, "fx_source").withColumn("path_lower", F.lower("path_display"))


@query(
    f"""WITH {_ELIGIBLE} SELECT file_id, rev, content_hash FROM e WHERE NOT EXISTS (
        SELECT 1 FROM fx_version_state v WHERE v.file_id = e.file_id AND v.rev = e.rev
          AND v.content_hash = e.content_hash)""",
    uses=PLANNED,
)
def extraction_due(spark, sf):
    state = fixture(spark, sf, "fx_version_state")
    due = extraction_candidates(_extraction_files(spark, sf), state, SUFFIXES, 1)
    return due.select("file_id", "rev", "content_hash")


@query(f"WITH {_ELIGIBLE} SELECT file_id, rev, content_hash FROM e", uses=PLANNED)
def extraction_refresh(spark, sf):
    """A full refresh ignores what the state says is done."""
    state = fixture(spark, sf, "fx_version_state")
    due = extraction_candidates(
        _extraction_files(spark, sf), state, SUFFIXES, 1, mode="full_refresh"
    )
    return due.select("file_id", "rev", "content_hash")


EXTRACTED = "fx_source fx_version_state fx_extraction_results"
_CONTENTS = f"""{_ELIGIBLE}, f AS (SELECT e.file_id, e.rev, e.content_hash, e.path_display,
    lower(e.path_display) AS path_lower, extraction_status, markdown, error_type,
    CASE WHEN extraction_status = 'failed' THEN 'conversion_error' END AS error_code,
    CASE extraction_status WHEN 'failed' THEN concat('Extraction failed: ', error_type, '.')
      WHEN 'timed_out' THEN 'Extraction timed out.' END AS error_message
  FROM e JOIN fx_extraction_results x USING (file_id, rev, content_hash))"""


def _contents(spark, sf):
    results = fixture(spark, sf, "fx_extraction_results").select(
        "file_id",
        "rev",
        "content_hash",
        F.col("extraction_status").alias("status"),
        "markdown",
        "error_type",
        F.when(F.col("extraction_status") == "failed", F.lit("conversion_error")).alias(
            "error_code"
        ),
        F.lit(None).cast("string").alias("error_message"),
    )
    candidates = extraction_candidates(
        _extraction_files(spark, sf).withColumn("server_modified", F.lit(None).cast("string")),
        None, SUFFIXES, 1,
    )
    return file_contents(candidates, results)


@query(
    f"""WITH {_CONTENTS} SELECT file_id, rev, extraction_status, md5(markdown) AS markdown_md5,
      error_type, error_code, CASE WHEN extraction_status = 'failed' THEN error_type END
        AS detail_type, error_message FROM f""",
    uses=EXTRACTED,
)
def document_contents(spark, sf):
    return _contents(spark, sf).select(
        "file_id", "rev", "extraction_status", F.md5("markdown").alias("markdown_md5"),
        "error_type", "error_code", F.col("error_details.type").alias("detail_type"),
        "error_message",
    )


@query(
    f"""WITH {_CONTENTS} SELECT file_id, rev, content_hash, path_lower AS path FROM f
      WHERE extraction_status IN ('succeeded', 'failed')
      UNION ALL SELECT v.file_id, v.rev, v.content_hash, v.path FROM fx_version_state v
      WHERE v.file_id NOT IN (SELECT file_id FROM f
        WHERE extraction_status IN ('succeeded', 'failed'))""",
    uses=EXTRACTED,
)
def extraction_state(spark, sf):
    state = fixture(spark, sf, "fx_version_state").select("file_id", "rev", "content_hash", "path")
    return advance_extraction_state(state, _contents(spark, sf))


@query(
    f"""WITH {_CONTENTS} SELECT file_id, path_display, markdown FROM f
      WHERE extraction_status = 'succeeded'""",
    uses=EXTRACTED,
)
def succeeded_documents(spark, sf):
    return warehouse.succeeded_documents(_contents(spark, sf))


@query(
    f"""WITH {_CONTENTS} SELECT error_code, count(*) AS documents FROM f
      WHERE extraction_status = 'failed' GROUP BY error_code""",
    uses=EXTRACTED,
)
def failures_by_code(spark, sf):
    return warehouse.failures_by_code(_contents(spark, sf))


def _target(spark, sf):
    return fixture(spark, sf, "fx_destination").select(
        F.col("path_display").alias("path"), "content_hash"
    )


_APPLIED = """o AS (SELECT o.*, t.path_display IS NULL AS absent, t.content_hash AS old_hash,
      n.path_display IS NOT NULL AS taken, n.content_hash AS new_hash
    FROM fx_operations o
    LEFT JOIN fx_destination t ON t.path_display = concat('/Destination-Root/', o.old_path)
    LEFT JOIN fx_destination n ON n.path_display = concat('/Destination-Root/', o.new_path)),
  r AS (SELECT idx, operation, old_path, old_content_hash, new_path, CASE
      WHEN operation = 'delete' THEN CASE WHEN absent THEN 'already_absent'
        WHEN old_hash IS DISTINCT FROM old_content_hash THEN 'error_target_changed'
        ELSE 'deleted' END
      WHEN absent THEN CASE WHEN taken AND new_hash IN (old_content_hash, new_content_hash)
        THEN 'already_moved' ELSE 'error_source_unavailable' END
      WHEN old_hash IS DISTINCT FROM old_content_hash THEN 'error_source_changed'
      WHEN taken THEN 'error_destination_exists' ELSE 'moved' END AS outcome FROM o)"""


@query(f"WITH {_APPLIED} SELECT idx, outcome FROM r", uses="fx_operations fx_destination")
def applied_operations(spark, sf):
    """No two operations share a path: settled in one pass."""
    ops = fixture(spark, sf, "fx_operations")
    return apply_operations(ops, _target(spark, sf), "/Destination-Root").select("idx", "outcome")


@query(
    f"""WITH {_APPLIED}, again AS (SELECT f.idx, CASE r.outcome WHEN 'moved' THEN 'already_moved'
        WHEN 'deleted' THEN 'already_absent' ELSE r.outcome END AS outcome
      FROM fx_follow_ups f JOIN r ON f.idx = r.idx + 1000000000),
    chain AS (SELECT f.idx, CASE
        WHEN r.outcome = 'moved' THEN 'moved'
        WHEN d.path_display IS NULL THEN 'error_source_unavailable'
        WHEN d.content_hash IS DISTINCT FROM f.old_content_hash THEN 'error_source_changed'
        ELSE 'moved' END AS outcome
      FROM fx_follow_ups f JOIN r ON f.idx = r.idx + 2000000000
      LEFT JOIN fx_destination d ON d.path_display = concat('/Destination-Root/', f.old_path))
    SELECT idx, outcome FROM r UNION ALL SELECT idx, outcome FROM again
    UNION ALL SELECT idx, outcome FROM chain""",
    uses="fx_operations fx_follow_ups fx_destination",
)
def ordered_operations(spark, sf):
    """Replays and chains on shared paths: settled in rounds by index."""
    ops = fixture(spark, sf, "fx_operations").unionByName(fixture(spark, sf, "fx_follow_ups"))
    return apply_operations(ops, _target(spark, sf), "/Destination-Root").select("idx", "outcome")


