"""Sink for validated file records under the two conflict policies.

Content is never sorted or aggregated: which record wins a path is settled on narrow rows.
Bytes meet the plan in one anti join with the indexes that are not written. Where these are
few, they are broadcast by their measured size and the bytes stay in place; else the join is
on the record index, a key that cannot be skewed however many records share a path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.errors import ConfigurationError
from filetally.guards import require_empty
from filetally.session import materialize

CONFLICT_POLICIES = ("overwrite", "fail")
WRITTEN = ["idx", "destination_path", "content", "sha256", "modified_at"]


def _policy(policy: str) -> str:
    if policy not in CONFLICT_POLICIES:
        raise ConfigurationError(f"conflict policy {policy!r} is none of {CONFLICT_POLICIES}.")
    return policy


def plan_writes(
    validated: DataFrame, existing: DataFrame | None = None, policy: str = "overwrite"
) -> DataFrame:
    """``idx, destination_path, outcome`` for each record of one ordered run.

    Records are applied in order until the first failing one, so later ones are
    ``not_reached``. ``overwrite`` keeps the last record of a path (earlier ones are
    ``superseded``); ``fail`` makes the first record whose path is taken, by ``existing``
    or by an earlier record, a ``conflict`` that also ends the run.
    """
    _policy(policy)
    narrow = validated.selectExpr(
        "idx", "destination_path", "error IS NOT NULL AS bad", "false AS conflict"
    )
    # Written once, because it is read several times and validation decodes and hashes.
    marked = materialize(narrow, "record-verdicts")
    if policy == "fail":
        # A path's first sound record is the only one that may be written to it.
        first = marked.where("NOT bad").groupBy("destination_path").agg(F.expr("min(idx) AS idx"))
        if existing is not None:
            taken = existing.select("destination_path").distinct()
            first = first.join(taken, "destination_path", "left_anti")
        allowed = first.selectExpr("idx", "true AS allowed")
        marked = marked.join(allowed, "idx", "left").selectExpr(
            "idx", "destination_path", "bad", "NOT bad AND allowed IS NULL AS conflict"
        )
    # A scalar subquery: the index the run ended at, null if it did not.
    stop = marked.where("bad OR conflict").agg(F.expr("min(idx)")).scalar()
    outcome = """CASE WHEN stop IS NULL OR idx < stop THEN 'written'
        WHEN idx > stop THEN 'not_reached' WHEN bad THEN 'invalid' ELSE 'conflict' END"""
    staged = marked.withColumn("stop", stop).selectExpr(
        "idx", "destination_path", f"{outcome} AS outcome"
    )
    if policy == "fail":
        return staged
    last = (
        staged.where("outcome = 'written'")
        .groupBy("destination_path")
        .agg(F.expr("max(idx) AS idx"))
        .selectExpr("idx", "true AS last")
    )
    return staged.join(last, "idx", "left").selectExpr(
        "idx",
        "destination_path",
        "CASE WHEN outcome = 'written' AND last IS NULL THEN 'superseded' ELSE outcome END "
        "AS outcome",
    )


def write_records(
    validated: DataFrame,
    target: str,
    policy: str = "overwrite",
    existing: DataFrame | None = None,
    fail_closed: bool = True,
) -> DataFrame:
    """Write the winning records of a run as Parquet to its folder and return the plan.

    ``fail_closed`` refuses to write anything when a record is invalid or in conflict;
    otherwise the records before the first failing one are written. A replayed run
    replaces its folder and converges on the same content.
    """
    plan = materialize(plan_writes(validated, existing, policy), "write-plan")
    if fail_closed:
        bad = plan.where("outcome IN ('invalid', 'conflict')")
        require_empty(bad, "Records are invalid or in conflict; nothing was written.")
    unwritten = plan.where("outcome <> 'written'").select("idx")
    written = validated.select(*WRITTEN).join(unwritten, "idx", "left_anti")
    written.write.mode("overwrite").parquet(target)
    return plan
