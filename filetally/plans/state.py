"""Fold an executed plan into the next state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.guards import require
from filetally.schemas import TRANSFER_STATE


def _folded(state: DataFrame, operations: DataFrame, transferred: DataFrame) -> DataFrame:
    """``file_id, v`` for every id of the three inputs; ``v`` is null where it is dropped.

    The inputs share one exchange on ``file_id``.
    """
    parts = (
        state.selectExpr("file_id", "struct(path, rev, content_hash) AS stored")
        .unionByName(
            operations.selectExpr(
                "file_id",
                "CASE WHEN operation = 'move' THEN new_path END AS moved",
                "CASE WHEN operation = 'delete' THEN true END AS deleted",
            ),
            allowMissingColumns=True,
        )
        .unionByName(
            transferred.selectExpr("file_id", "struct(path, rev, content_hash) AS sent"),
            allowMissingColumns=True,
        )
    )
    folded = parts.groupBy("file_id").agg(
        *[F.expr(f"any_value({c}, true) AS {c}") for c in ("stored", "moved", "deleted", "sent")]
    )
    folded = require(
        folded,
        "stored IS NOT NULL OR (moved IS NULL AND deleted IS NULL)",
        "'A move or delete does not match the state.'",
    )
    kept = """CASE WHEN deleted IS NULL THEN struct(coalesce(moved, stored.path) AS path,
        stored.rev AS rev, stored.content_hash AS content_hash) END"""
    return folded.selectExpr("file_id", f"coalesce(sent, {kept}) AS v")


def next_state(state: DataFrame, operations: DataFrame, transferred: DataFrame) -> DataFrame:
    """Moves rename and keep the version, deletes drop, transfers store the new version.

    Order is operations, then files, so a deleted id that is transferred again stays. An
    operation on an unknown id fails.
    """
    folded = _folded(state, operations, transferred).where("v IS NOT NULL")
    return folded.select("file_id", "v.*").select(*TRANSFER_STATE.names)


def state_changes(state: DataFrame, operations: DataFrame, transferred: DataFrame) -> DataFrame:
    """Only the rows ``next_state`` would change, with ``removed`` for dropped ids.

    The state is filtered to the ids the plan names, so its bulk is neither shuffled nor
    written again.
    """
    named = operations.select("file_id").unionByName(transferred.select("file_id")).distinct()
    touched = state.join(named, "file_id", "left_semi")
    folded = _folded(touched, operations, transferred)
    return folded.selectExpr("file_id", "v.path", "v.rev", "v.content_hash", "v IS NULL AS removed")
