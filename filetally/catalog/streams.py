"""Streaming forms over landed pages of the benchmark tables; each equals its batch form."""

from pyspark.sql import functions as F

from filetally.catalog.inventory import _ENTRY, _ENTRY_COLUMNS
from filetally.catalog.migration import _ELIGIBLE, SUFFIXES
from filetally.catalog.writing import _GATE, _RECORDS
from filetally.catalog.registry import change_listing, file_listing, query
from filetally.fixtures import fixture
from filetally.session import scratch
from filetally.sources.listing import land_listing, stream_listing, stream_pages
from filetally.sources.state import Scope, read_state
from filetally.operators.records import validate_records
from filetally.streaming import (
    current_entries,
    entry_view,
    read_changes,
    read_checkpoints,
    read_ledger,
    read_records,
    start_change_stream,
    start_extraction_stream,
    start_gate_stream,
    start_migration_stream,
    start_record_stream,
    start_view_stream,
)


LANDED = 250_000  # rows of a landed file: what a task sorts at once


def _pieces(rows, least):
    """Into how many pieces of about ``LANDED`` rows the rows go, ``least`` at least."""
    return max(least, -(-rows.count() // LANDED))


def _landed(spark, rows, label):
    """Listing rows landed as files by page range, as a feed would deliver them, in two batches.

    Their number follows the rows, so that a file holds as many whatever the size of the feed.
    """
    path = scratch(spark, label)
    files = _pieces(rows, 2)
    rows.repartitionByRange(files, "page").sortWithinPartitions("ordinal").write.parquet(path)
    return stream_listing(spark, path, layout="rows", files_per_trigger=-(-files // 2))


def _changes(spark, sf):
    target = scratch(spark, "change-log")
    listing = _landed(spark, change_listing(spark, sf), "change-pages")
    start_change_stream(listing, target, f"{target}-checkpoint").awaitTermination()
    return read_changes(spark, target)


@query(_ENTRY, uses="fx_change_log")
def streamed_changes(spark, sf):
    """Page-atomic change log."""
    return _changes(spark, sf).select("ordinal", *_ENTRY_COLUMNS)


@query(
    f"""WITH e AS ({_ENTRY}), ranked AS (SELECT *, row_number() OVER (PARTITION BY entry_key
        ORDER BY ordinal DESC) AS rn FROM e)
      SELECT {', '.join(_ENTRY_COLUMNS)} FROM ranked WHERE rn = 1""",
    uses="fx_change_log",
)
def streamed_current_entries(spark, sf):
    """Latest row per key over the streamed log."""
    return current_entries(_changes(spark, sf)).select(*_ENTRY_COLUMNS)


@query(
    """SELECT file_id, CASE WHEN starts_with(path_display, '/Source-Root/')
        THEN substr(path_display, 14) ELSE ltrim(path_display, '/') END AS path, rev, content_hash
      FROM fx_source""",
    uses="fx_source",
)
def streamed_migration_state(spark, sf):
    """Every page planned, carried out and folded into the state."""
    target = scratch(spark, "migration")
    listing = _landed(spark, file_listing(spark, sf, "fx_source"), "source-pages")
    start_migration_stream(
        listing, target, f"{target}-checkpoint", Scope("/Source-Root"),
        rename_policy="propagate",
    ).awaitTermination()
    return read_state(spark, f"{target}/state").files


PAGE = 500


@query(
    """SELECT file_id, CASE WHEN ordinal % 5 = 0 THEN 'moved/' ELSE '' END
        || substr(path_display, 14) AS path, rev, content_hash,
      CASE WHEN ordinal % 5 = 0 THEN 'move' END AS operation
      FROM fx_source WHERE starts_with(path_display, '/Source-Root/')""",
    uses="fx_source",
)
def streamed_migration_runs(spark, sf):
    """Renames over a run of pages: every tombstone lands in an earlier file than its new path.

    The pages of the first run are one snapshot, those of the second one delta. Each run's
    last page lands by itself, so the batches before it have to wait.
    """
    target = scratch(spark, "migration-runs")
    files = file_listing(spark, sf, "fx_source")
    pages = files.agg(F.expr(f"max(ordinal) div {PAGE} + 1")).first()[0]
    moved = files.where("ordinal % 5 = 0")
    gone = moved.selectExpr(
        "path_display", "path_lower", "name", "'deleted' AS entry_type",
        f"{pages * PAGE} + ordinal div 5 AS ordinal",
    )
    back = -(-pages // 5) * PAGE
    come = moved.selectExpr(
        *[c for c in moved.columns if not c.startswith("path_") and c != "ordinal"],
        "replace(path_display, '/Source-Root/', '/Source-Root/moved/') AS path_display",
        "replace(path_lower, '/source-root/', '/source-root/moved/') AS path_lower",
        f"{pages * PAGE + back} + ordinal div 5 AS ordinal",
    )
    total = come.agg(F.expr(f"max(ordinal) div {PAGE} + 1")).first()[0]
    landed = scratch(spark, "run-pages")
    for first, end in ((0, pages - 1), (pages - 1, pages), (pages, total - 1), (total - 1, total)):
        every = files.unionByName(gone, allowMissingColumns=True).unionByName(come)
        part = every.where(f"ordinal div {PAGE} >= {first} AND ordinal div {PAGE} < {end}")
        land_listing(part, landed, PAGE, f"page NOT IN ({pages - 1}, {total - 1})")
    start_migration_stream(
        stream_pages(spark, landed), target, f"{target}-checkpoint", Scope("/Source-Root"),
        rename_policy="propagate", delete_policy="delete",
    ).awaitTermination()
    done = spark.read.parquet(f"{target}/decisions").where("operation IS NOT NULL")
    return read_state(spark, f"{target}/state").files.join(
        done.select("file_id", "operation"), "file_id", "left"
    )


def _results(spark, sf):
    return fixture(spark, sf, "fx_extraction_results").select(
        "file_id", "rev", "content_hash", F.col("extraction_status").alias("status"), "markdown",
        "error_type", F.lit(None).cast("string").alias("error_code"),
        F.lit(None).cast("string").alias("error_message"),
    )


@query(
    f"""WITH {_ELIGIBLE} SELECT e.file_id, e.rev, e.content_hash, lower(e.path_display) AS path
      FROM e JOIN fx_extraction_results x USING (file_id, rev, content_hash)
      WHERE extraction_status <> 'timed_out'""",
    uses="fx_source fx_extraction_results",
)
def streamed_extraction_state(spark, sf):
    """Every page extracted; timed-out documents stay due."""
    target = scratch(spark, "extraction")
    results = _results(spark, sf)
    listing = _landed(spark, file_listing(spark, sf, "fx_source"), "document-pages")
    start_extraction_stream(
        listing, target, f"{target}-checkpoint", lambda due: results, SUFFIXES, 1
    ).awaitTermination()
    return read_state(spark, f"{target}/state", kind="extraction").files.select(
        "file_id", "rev", "content_hash", "path"
    )


@query(
    f"""WITH {_ELIGIBLE} SELECT e.file_id, e.rev, e.content_hash, lower(e.path_display) AS path,
        CASE WHEN extraction_status = 'timed_out' THEN 2 ELSE 1 END AS attempts
      FROM e JOIN fx_extraction_results x USING (file_id, rev, content_hash)""",
    uses="fx_source fx_extraction_results",
)
def streamed_extraction_retries(spark, sf):
    """A second run, for which nothing lands, settles what timed out in the first."""
    target = scratch(spark, "extraction-retries")
    results = _results(spark, sf)
    late = results.withColumn("markdown", F.coalesce("markdown", F.lit("#"))).selectExpr(
        "* EXCEPT (status, markdown, error_type)",
        "CASE WHEN status = 'timed_out' THEN 'succeeded' ELSE status END AS status",
        "CASE WHEN status <> 'failed' THEN markdown END AS markdown",
        "CASE WHEN status <> 'timed_out' THEN error_type END AS error_type",
    )
    folder = scratch(spark, "retried-pages")
    file_listing(spark, sf, "fx_source").write.parquet(folder)
    for answers in (results, late):
        # All that has landed is one batch, so what times out in it is left to the second run.
        listing = stream_listing(spark, folder, layout="rows", files_per_trigger=None)
        start_extraction_stream(
            listing, target, f"{target}-checkpoint",
            lambda due, answers=answers: answers.join(due.select("file_id"), "file_id", "left_semi"),
            SUFFIXES, 1,
        ).awaitTermination()
    records = spark.read.parquet(f"{target}/file_contents")
    attempts = records.groupBy("file_id").agg(F.count("*").alias("attempts"))
    state = read_state(spark, f"{target}/state", kind="extraction").files
    return state.join(attempts, "file_id").select(
        "file_id", "rev", "content_hash", "path", "attempts"
    )


@query(
    f"""WITH e AS ({_ENTRY}), ranked AS (SELECT *, row_number() OVER (PARTITION BY entry_key
        ORDER BY ordinal DESC) AS rn FROM e)
      SELECT {', '.join(_ENTRY_COLUMNS)} FROM ranked WHERE rn = 1""",
    uses="fx_change_log",
)
def streamed_entry_view(spark, sf):
    """Latest row per key, kept up to date page by page in the buckets of its keys.

    A bucket is merged by one task, so their number follows the rows of the feed: there are never
    more keys.
    """
    target = scratch(spark, "entry-view")
    changes = change_listing(spark, sf)
    listing = _landed(spark, changes, "view-pages")
    view = entry_view(listing, target, buckets=_pieces(changes, 16))
    start_view_stream(listing, view, f"{target}-checkpoint").awaitTermination()
    return view.read(spark).select(*_ENTRY_COLUMNS)


def _in_order(spark, rows, label, column, parts):
    """Land ``parts`` ranges of a column one after the other; a stream of rows after each.

    A run of the stream takes what has landed since the one before as one batch, so a range may
    land in as many files as its tasks write.
    """
    folder = scratch(spark, label)
    low, high = rows.agg(F.min(column), F.max(column)).first()
    width = -(-(high - low + 1) // parts)
    for k in range(parts):
        part = rows.where(F.col(column).between(low + k * width, low + (k + 1) * width - 1))
        part.write.mode("append").parquet(folder)
        yield spark.readStream.schema(rows.schema).parquet(folder)


@query(
    f"""WITH {_RECORDS}, t AS (SELECT idx, error IS NULL AS sound,
        CASE WHEN error IS NULL THEN concat('/Exports/', path) END AS path,
        md5(from_base64(content_base64)) AS m FROM v),
      s AS (SELECT min(idx) AS stop FROM t WHERE NOT sound),
      w AS (SELECT *, CASE WHEN stop IS NULL OR idx < stop THEN 'written' WHEN idx = stop
        THEN 'invalid' ELSE 'not_reached' END AS outcome FROM t, s)
      SELECT idx, path AS destination_path, CASE WHEN outcome = 'written' AND idx < max(idx) FILTER
          (outcome = 'written') OVER (PARTITION BY path) THEN 'superseded' ELSE outcome END AS outcome
      FROM w""",
    uses="fx_records",
)
def streamed_records(spark, sf):
    """Every record, sound or not, through the sink in three batches: the ledger."""
    target = scratch(spark, "record-stream")
    for raw in _in_order(spark, fixture(spark, sf, "fx_records"), "landed-records", "idx", 3):
        checked = validate_records(raw, "/Exports", max_mb=1, streams=["documents"])
        start_record_stream(checked, target, f"{target}-checkpoint").awaitTermination()
    return read_ledger(spark, target)


@query(
    f"""WITH {_RECORDS}, t AS (SELECT idx, 'f/' || CAST(idx % 97 AS VARCHAR) AS path FROM v
        WHERE error IS NULL)
      SELECT max(t.idx) AS idx, t.path AS destination_path,
      max_by(md5(from_base64(v.content_base64)), t.idx) AS content_md5
      FROM t JOIN v USING (idx) GROUP BY t.path""",
    uses="fx_records",
)
def streamed_files(spark, sf):
    """Sound records sent to 97 paths in three batches: later batches supersede earlier ones."""
    target = scratch(spark, "file-stream")
    for raw in _in_order(spark, fixture(spark, sf, "fx_records"), "landed-files", "idx", 3):
        checked = validate_records(raw, "/Exports", max_mb=1, streams=["documents"])
        sound = checked.where("error IS NULL").withColumn(
            "destination_path", F.concat(F.lit("f/"), (F.col("idx") % 97).cast("string"))
        )
        start_record_stream(sound, target, f"{target}-checkpoint").awaitTermination()
    return read_records(spark, target).select(
        "idx", "destination_path", F.md5("content").alias("content_md5")
    )


@query(_GATE, uses="fx_write_log")
def streamed_checkpoints(spark, sf):
    """Checkpoints released as the log arrives, in three batches."""
    target = scratch(spark, "gate")
    for log in _in_order(spark, fixture(spark, sf, "fx_write_log"), "landed-log", "idx", 3):
        start_gate_stream(log, target, f"{target}-checkpoint").awaitTermination()
    return read_checkpoints(spark, target).select(
        F.col("run").cast("long").alias("run"), "idx", "path", "released"
    )
