"""Snapshot plan: a complete inventory against the stored versions."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from filetally.errors import ContractError
from filetally.guards import NEVER
from filetally.operators.keyed import named, pair_by_key, unique_sides
from filetally.plans.migration import Plan, check_policies, checked_versions, decisions
from filetally.sources.state import Scope, State


def _scoped_state(state: State, scope: Scope, propagates: bool) -> State:
    """Adopt the scope, refuse a propagating plan over another one, else start afresh."""
    if not state.legacy and state.scope in (None, scope):
        return replace(state, scope=scope)
    if propagates:
        raise ContractError(
            "The state has no traversal scope or another one; disable propagation for one "
            "fresh inventory."
        )
    nothing = state.files.sparkSession.createDataFrame([], state.files.schema)
    return replace(state, files=nothing, scope=scope, layout=3)


def plan_snapshot(
    inventory: DataFrame,
    state: State,
    *,
    scope: Scope,
    rename_policy: str = "ignore",
    delete_policy: str = "ignore",
) -> Plan:
    """Plan from every file there is; ids absent from it are gone.

    ``inventory`` holds ``file_id, path, rev, content_hash, size, transferable``. Files over
    the size cap take part, so they can be moved and are never deleted, but not
    transferred. One exchange on ``file_id`` pairs both sides and checks for duplicates.
    """
    propagates = check_policies(rename_policy, delete_policy)
    state = _scoped_state(state, scope, propagates)
    current = checked_versions(inventory).select(
        "file_id", "path", "rev", "content_hash", "size", "transferable"
    )
    paired = unique_sides(
        pair_by_key(current, state.files, ["file_id"]),
        named("Inventory contains duplicate file_id ", "file_id"),
    ).selectExpr("file_id", "left AS now", "right AS prior")
    gone = "now IS NULL" if delete_policy == "delete" else NEVER
    return Plan(decisions(paired, rename_policy, gone), state)
