"""Incremental migration and extraction as micro-batches over landed pages.

Per batch: plan against the newest state before this batch, write the decisions, write the
state last, and of the state only what changed. State versions carry the batch id, so a
repeated batch reads the same state it read the first time and writes the same version again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from filetally.errors import ConfigurationError, ContractError
from filetally.guards import require_empty
from filetally.operators.keyed import dedupe_replay
from filetally.operators.versions import (
    advance_extraction_state,
    extraction_candidates,
    file_contents,
    settled_versions,
    skipped_documents,
)
from filetally.plans.delta import deduplicate_changes, plan_delta, split_delta
from filetally.plans.migration import Plan, migration_inventory, skipped_files
from filetally.plans.snapshot import plan_snapshot
from filetally.plans.state import next_state, state_changes
from filetally.schemas import TRANSFER_STATE
from filetally.session import materialize
from filetally.sources.listing import scope_listing
from filetally.sources.keyed_state import KeyedState
from filetally.sources.state import Scope, read_header, read_state, write_header, write_state
from filetally.streaming.runs import end_run, gather_run
from filetally.sources.written import read_written


def migrate_batch(
    batch: DataFrame,
    batch_id: int,
    target: str,
    scope: Scope,
    *,
    rename_policy: str = "ignore",
    delete_policy: str = "ignore",
    max_mb: int = 1024,
    globs: list[str] | None = None,
    transfer: Callable[[DataFrame], DataFrame] | None = None,
    cursor: str | None = None,
    keyed: bool = False,
) -> None:
    """One batch: everything is new when there is no state yet, else it is a delta.

    A batch is planned as one delta, so a rename and the tombstone of its old path belong in
    one batch; a stream of pages sees to that. ``cursor`` is what the state continues from,
    by default a name made of the batch id. Files over the size cap are listed in ``skipped``.
    A ``keyed`` state is kept in buckets, of which a batch reads and writes those of the ids and
    paths it names.

    ``transfer`` does the copying: it gets the transfer rows and returns those that
    succeeded. If one did not, the batch fails before its state and cursor are written, but what
    was delivered is kept: a restart plans the batch again and asks only for the rest.
    """
    spark = batch.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        """Write a batch's intermediate once, in its own folder, and go on from there."""
        folder = f"{target}/{name}/batch_id={batch_id}"
        df.write.mode("overwrite").parquet(folder)
        return spark.read.schema(df.schema).parquet(folder)

    stored(skipped_files(batch, scope.path, max_mb, globs), "skipped")
    table = KeyedState(f"{target}/state")
    if keyed:
        nothing = spark.createDataFrame([], TRANSFER_STATE)
        state = read_header(spark, f"{target}/state", nothing, before=batch_id)
    else:
        state = read_state(spark, f"{target}/state", before=batch_id)
    policies = {"rename_policy": rename_policy, "delete_policy": delete_policy}
    if state.can_resume:
        changed, tombstones = split_delta(batch, scope.path, max_mb, globs)
        changed = stored(deduplicate_changes(changed), "changes")
        tombstones = stored(tombstones, "tombstones")
        if keyed:
            state = replace(state, files=table.named(changed, tombstones, batch_id))
        plan = plan_delta(changed, tombstones, state, scope=scope, **policies)
    elif state.version is not None:
        raise ContractError("The state has no cursor; commit a complete snapshot first.")
    else:
        inventory = migration_inventory(batch, scope.path, max_mb, globs)
        plan = plan_snapshot(deduplicate_changes(inventory), state, scope=scope, **policies)
    plan = Plan(stored(plan.decisions, "decisions"), plan.state)
    sent = plan.transfers
    if transfer is not None:
        version = ["file_id", "path", "rev", "content_hash"]
        folder = f"{target}/transferred/batch_id={batch_id}"
        before = read_written(spark, folder, sent.schema).select(*version).distinct()
        due = stored(sent.join(before, version, "left_anti"), "due")
        transfer(due).select(*due.columns).write.mode("append").parquet(folder)
        delivered = read_written(spark, folder, sent.schema).select(*version).distinct()
        require_empty(
            sent.join(delivered, version, "left_anti"),
            f"Transfers of batch {batch_id} failed; its state was not advanced.",
        )
    files, operations = plan.state.files, plan.operations
    after = cursor or f"batch-{batch_id}"
    if keyed:
        table.merge(state_changes(files, operations, sent), batch_id)
        write_header(plan.state.advanced(files, after, scope), f"{target}/state", batch_id)
        return
    advanced = plan.state.advanced(
        next_state(files, operations, sent), after, scope
    )
    changes = state_changes(files, operations, sent) if state.can_resume else None
    write_state(advanced, f"{target}/state", batch_id, changes=changes)


def start_migration_stream(
    listing: DataFrame,
    target: str,
    checkpoint: str,
    scope: Scope,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Plan and commit what has landed; the checkpoint commits after the state.

    ``listing`` is a stream of pages or of rows. Pages are gathered until one of them ends
    their cursor run, whichever files they land in; the run is then planned as a whole and its
    cursor is the state's. Rows say nothing of runs, so each batch of them is a delta.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        migrate_batch(batch, batch_id, target, scope, **options)

    def run_of_pages(batch: DataFrame, batch_id: int) -> None:
        found = gather_run(batch, batch_id, target)
        if found is not None:
            rows = scope_listing(found.rows, scope.path, scope.recursive)
            migrate_batch(rows, batch_id, target, scope, cursor=found.cursor, **options)
            end_run(found, batch.sparkSession, batch_id, target)

    if "entries" in listing.columns:
        run = run_of_pages

    return (
        listing.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def extract_batch(
    batch: DataFrame,
    batch_id: int,
    target: str,
    extract: Callable[[DataFrame], DataFrame],
    suffixes: list[str],
    max_mb: int = 10,
) -> None:
    """One batch: candidates, their outcomes, then the advanced state.

    Candidates are the batch's versions and those that timed out before; the latter are kept
    in ``pending`` with the batch that left them, so they need not be landed again. A batch
    without timeouts leaves no file there. Documents over the size cap are listed in ``skipped``.
    """
    spark = batch.sparkSession
    state = read_state(spark, f"{target}/state", kind="extraction", before=batch_id)
    latest = dedupe_replay(
        batch.where("entry_type = 'file'").withColumnRenamed("id", "file_id"),
        ["file_id"],
        ["ordinal"],
    )
    # What had timed out when the batch before ended.
    waiting = read_written(spark, f"{target}/pending/batch_id={batch_id - 1}", latest.schema)
    due = latest.unionByName(waiting.join(latest.select("file_id"), "file_id", "left_anti"))
    skipped_documents(latest, suffixes, max_mb).write.mode("overwrite").parquet(
        f"{target}/skipped/batch_id={batch_id}"
    )
    candidates = materialize(
        extraction_candidates(due, state.files, suffixes, max_mb), "extraction-candidates"
    )
    folder = f"{target}/file_contents/batch_id={batch_id}"
    records = file_contents(candidates, extract(candidates))
    records.write.mode("overwrite").parquet(folder)
    written = spark.read.schema(records.schema).parquet(folder)
    version = ["file_id", "rev", "content_hash"]
    timed_out = written.where("extraction_status = 'timed_out'").select(*version)
    left = f"{target}/pending/batch_id={batch_id}"
    # An earlier attempt at this batch may have left some that have now been settled.
    if not (timed_out.isEmpty() and read_written(spark, left, latest.schema).isEmpty()):
        due.join(timed_out, version, "left_semi").write.mode("overwrite").parquet(left)
    complete = replace(state, files=advance_extraction_state(state.files, written), layout=1)
    changes = settled_versions(written).selectExpr("*", "false AS removed")
    write_state(complete, f"{target}/state", batch_id, kind="extraction", changes=changes)


def start_extraction_stream(
    listing: DataFrame,
    target: str,
    checkpoint: str,
    extract: Callable[[DataFrame], DataFrame],
    suffixes: list[str],
    max_mb: int = 10,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Extract new versions of landed pages, and again what timed out before.

    What a batch leaves pending is itself a source of the stream: its files wake the query
    when no page lands, at the next run or, under a repeated trigger, in the next batch. Which
    documents are due is read from the batch before; a newer version may have come meanwhile.
    """
    spark = listing.sparkSession
    if "entries" in listing.columns:
        raise ConfigurationError("Extraction reads rows; use stream_listing.")
    pending = f"{target}/pending"
    names = T.StructType([f for f in listing.schema.fields if f.name == "ordinal"])
    spark.createDataFrame([], names).write.mode("ignore").parquet(pending)
    woken = spark.readStream.schema(names).option("recursiveFileLookup", "true").parquet(pending)
    landed = listing.withColumn("woken", F.lit(False)).unionByName(
        woken.withColumn("woken", F.lit(True)), allowMissingColumns=True
    )

    def run(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.where("NOT woken").drop("woken")
        extract_batch(fresh, batch_id, target, extract, suffixes, max_mb)

    return (
        landed.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
