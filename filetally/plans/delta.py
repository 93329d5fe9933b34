"""Delta plan: changed files and tombstone paths against the stored versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.errors import ContractError
from filetally.functions.paths import fold, transfer_path
from filetally.guards import NEVER
from filetally.operators.keyed import dedupe_replay
from filetally.plans.migration import (
    Plan,
    check_policies,
    checked_versions,
    decisions,
    migration_inventory,
)
from filetally.session import materialize
from filetally.sources.state import Scope, State


def split_delta(
    listing: DataFrame, root: str, max_mb: int = 1024, globs: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Changed files and tombstone paths of a change listing.

    Unlike in a snapshot, oversized files are removed before planning, so a renamed
    oversized file does not consume its tombstone.
    """
    changed = migration_inventory(listing, root, max_mb, globs).where("transferable")
    tombstones = (
        listing.where("entry_type = 'deleted'")
        .selectExpr("coalesce(nullif(path_display, ''), path_lower) AS shown")
        .where("shown <> ''")
        .selectExpr(f"{transfer_path('shown', 'shown', root)} AS path")
    )
    return changed, tombstones


def deduplicate_changes(changed: DataFrame) -> DataFrame:
    """Last change per file id by ``ordinal``; the plan needs one row per id."""
    return dedupe_replay(changed, ["file_id"], ["ordinal"])


def plan_delta(
    changed: DataFrame,
    tombstones: DataFrame,
    state: State,
    *,
    scope: Scope,
    rename_policy: str = "ignore",
    delete_policy: str = "ignore",
) -> Plan:
    """Plan from what changed only. ``changed`` has one row per file id.

    A change at another path consumes the tombstone of the old path under either rename
    policy. Tombstones compare folded, and are distinct after folding; if several stored
    paths fold alike, the greatest file id is deleted.

    State rows are reduced to the ids and paths the delta names before anything else, so
    the state is scanned and filtered (by broadcast when the delta is measured to be small)
    but its bulk is not carried through the plan.
    """
    check_policies(rename_policy, delete_policy)
    if state.scope != scope:
        raise ContractError("The state scope does not match the configured traversal scope.")
    current = checked_versions(changed)
    if "transferable" not in current.columns:
        current = current.withColumn("transferable", F.lit(True))
    now = current.selectExpr(
        "file_id", "struct(path, rev, content_hash, size, transferable) AS now"
    )
    touched = state.files.join(now.select("file_id"), "file_id", "left_semi")
    stored = touched.selectExpr("file_id", "struct(path, rev, content_hash) AS prior")
    # Written once, because decisions and consumed tombstones both read it.
    paired = materialize(now.join(stored, "file_id", "left"), "delta-pairs")
    planned = decisions(paired, rename_policy, NEVER)
    if delete_policy != "delete":
        return Plan(planned, state)

    consumed = paired.where("now.path <> prior.path").selectExpr(f"{fold('prior.path')} AS folded")
    dead = (
        tombstones.selectExpr(f"{fold('path')} AS folded")
        .distinct()
        .join(consumed, "folded", "left_anti")
    )
    hits = state.files.selectExpr("*", f"{fold('path')} AS folded").join(dead, "folded")
    greatest = "max_by(struct(file_id, path, content_hash), file_id) AS s"
    deletes = hits.groupBy("folded").agg(F.expr(greatest)).selectExpr(
        "s.file_id AS file_id",
        "'delete' AS operation",
        "s.path AS old_path",
        "s.content_hash AS old_content_hash",
        "false AS transfer",
    )
    return Plan(planned.unionByName(deletes, allowMissingColumns=True), state)
