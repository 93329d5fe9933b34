"""What snapshot and delta plans share: the inventory, the policies, the plan itself."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from filetally.errors import ConfigurationError
from filetally.functions.paths import is_safe_relative, matches_globs, transfer_path
from filetally.guards import NEVER, non_empty, require
from filetally.operators.versions import with_transferable
from filetally.schemas import OPERATION
from filetally.sources.state import State

PHASES = ("move", "delete", "transfer")


@dataclass(frozen=True)
class Plan:
    """One decision row per file id; operations and transfers are projections of it.

    ``decisions`` columns: ``file_id``, ``operation`` (move, delete or null),
    ``old_path, old_content_hash, new_path, new_content_hash`` for an operation,
    ``transfer`` and ``path, rev, content_hash, size`` of the file to transfer.
    Write ``decisions`` once and derive both from the written table to plan only once.
    """

    decisions: DataFrame
    state: State

    @property
    def operations(self) -> DataFrame:
        """Control rows; moves come before deletes, each by file id (``phase`` orders them)."""
        return self.decisions.where("operation IS NOT NULL").selectExpr(
            "CASE operation WHEN 'move' THEN 0 ELSE 1 END AS phase", *OPERATION.names
        )

    @property
    def transfers(self) -> DataFrame:
        """Files to transfer, at the path they are to be written to."""
        return self.decisions.where("transfer").selectExpr(
            "2 AS phase", "file_id", "path", "rev", "content_hash", "size"
        )


def check_policies(rename_policy: str, delete_policy: str) -> bool:
    """Check both; true if any of them propagates."""
    if rename_policy not in ("ignore", "propagate"):
        raise ConfigurationError("rename_policy must be ignore or propagate.")
    if delete_policy not in ("ignore", "delete"):
        raise ConfigurationError("delete_policy must be ignore or delete.")
    return rename_policy == "propagate" or delete_policy == "delete"


def migration_inventory(
    listing: DataFrame, root: str, max_mb: int = 1024, globs: list[str] | None = None
) -> DataFrame:
    """Files of a listing as planner input: transfer path, version, ``transferable`` mark."""
    rows = listing.where("entry_type = 'file'").selectExpr(
        "id AS file_id",
        f"{transfer_path('path_display', 'name', root)} AS path",
        "rev",
        "content_hash",
        "size",
        *[c for c in ("ordinal",) if c in listing.columns],
    )
    return with_transferable(rows.where(matches_globs("path", globs or [])), max_mb)


def skipped_files(
    listing: DataFrame, root: str, max_mb: int = 1024, globs: list[str] | None = None
) -> DataFrame:
    """An account of the files that no plan transfers: ``file_id, path, size, reason``.

    ``too_large`` is over the cap or of unknown size. Files outside the globs are no part of
    the migration and not listed.
    """
    inventory = migration_inventory(listing, root, max_mb, globs)
    return inventory.where("NOT coalesce(transferable, false)").selectExpr(
        "file_id", "path", "size", "'too_large' AS reason"
    )


def checked_versions(files: DataFrame) -> DataFrame:
    """Fail on a file without identity or with an unsafe path."""
    identified = non_empty("file_id", "rev", "content_hash")
    return require(
        files,
        f"{identified} AND {is_safe_relative('path')}",
        f"CASE WHEN {identified} THEN 'A file has an invalid path.' "
        "ELSE 'File metadata requires non-empty id, rev and content_hash.' END",
    )


def decisions(paired: DataFrame, rename_policy: str, delete: str) -> DataFrame:
    """The planning truth table over pairs of a current file ``now`` and a state row ``prior``.

    ``delete`` is SQL for where a state row is to be deleted; the other outcomes follow from
    presence, path (case-sensitive) and byte version. A changed file whose rename is
    ignored keeps its stored path.
    """
    both = "now IS NOT NULL AND prior IS NOT NULL"
    moves = "renamed" if rename_policy == "propagate" else NEVER
    facts = paired.selectExpr(
        "file_id",
        "now",
        "prior",
        "now IS NOT NULL AND prior IS NULL AS is_new",
        f"coalesce({both} AND now.path <> prior.path, false) AS renamed",
        f"coalesce({both} AND (now.rev <> prior.rev "
        "OR now.content_hash <> prior.content_hash), false) AS changed",
    )
    chosen = facts.selectExpr(
        "*",
        f"CASE WHEN {moves} THEN 'move' WHEN {delete} THEN 'delete' END AS operation",
        "(is_new OR changed) AND coalesce(now.transferable, false) AS transfer",
    ).where("operation IS NOT NULL OR transfer")
    return chosen.selectExpr(
        "file_id",
        "operation",
        "CASE WHEN operation IS NOT NULL THEN prior.path END AS old_path",
        "CASE WHEN operation IS NOT NULL THEN prior.content_hash END AS old_content_hash",
        "CASE WHEN operation = 'move' THEN now.path END AS new_path",
        "CASE WHEN operation = 'move' THEN now.content_hash END AS new_content_hash",
        "transfer",
        f"CASE WHEN transfer THEN CASE WHEN is_new OR {moves} THEN now.path ELSE prior.path END "
        "END AS path",
        "CASE WHEN transfer THEN now.rev END AS rev",
        "CASE WHEN transfer THEN now.content_hash END AS content_hash",
        "CASE WHEN transfer THEN now.size END AS size",
    )


def plan_migration(
    state: State,
    *,
    scope,
    inventory: DataFrame | None = None,
    changed: DataFrame | None = None,
    tombstones: DataFrame | None = None,
    rename_policy: str = "ignore",
    delete_policy: str = "ignore",
) -> Plan:
    """Delta when the state can resume and changes are given, else a snapshot.

    After a cursor reset pass the complete ``inventory`` only: the old cursor stays in the
    state until the rescan is committed.
    """
    from filetally.plans.delta import plan_delta
    from filetally.plans.snapshot import plan_snapshot

    if state.can_resume and changed is not None and tombstones is not None:
        return plan_delta(changed, tombstones, state, scope=scope, rename_policy=rename_policy,
                          delete_policy=delete_policy)
    if inventory is None:
        raise ConfigurationError("a snapshot plan needs the complete inventory.")
    return plan_snapshot(inventory, state, scope=scope, rename_policy=rename_policy,
                         delete_policy=delete_policy)
