"""Apply control records to a target index, idempotently."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filetally.functions.paths import target_path
from filetally.session import materialize

CHUNKS = 256  # ranges of the order in which a path's operations are looked through

EFFECTIVE = "outcome IN ('moved', 'deleted')"


def _outcome(old: str, new: str) -> str:
    """SQL for the outcome; ``old`` and ``new`` are structs of what is at the two paths.

    ``present`` says whether anything is; a null struct is an empty path.
    """
    there, taken = (f"coalesce({x}.present, false)" for x in (old, new))
    same = f"{old}.hash <=> old_content_hash"
    arrived = f"({new}.hash <=> old_content_hash OR {new}.hash <=> new_content_hash)"
    return f"""CASE WHEN operation = 'delete' THEN CASE
      WHEN NOT {there} THEN 'already_absent'
      WHEN NOT ({same}) THEN 'error_target_changed' ELSE 'deleted' END
    WHEN NOT {there} AND {taken} AND {arrived} THEN 'already_moved'
    WHEN NOT {there} THEN 'error_source_unavailable'
    WHEN NOT ({same}) THEN 'error_source_changed'
    WHEN {taken} THEN 'error_destination_exists' ELSE 'moved' END"""


def _resolve(ops: DataFrame, target: DataFrame) -> DataFrame:
    """Outcome of operations that do not touch each other's paths: two equi-joins by path.

    A delete has no new path. It gets a key of its own, which is no absolute path and so matches
    nothing, as null keys would all meet in one task.
    """
    state = "struct(true AS present, content_hash AS hash)"
    olds = target.selectExpr("path AS at_old", f"{state} AS old")
    news = target.selectExpr("path AS at_new", f"{state} AS new")
    joined = ops.join(olds, F.expr("from_path = at_old"), "left").join(
        news, F.expr("coalesce(to_path, concat('delete ', idx)) = at_new"), "left"
    )
    return joined.selectExpr(*ops.columns, f"{_outcome('old', 'new')} AS outcome")


_PATHS = "explode(array_compact(array(from_path, to_path))) AS path"


def target_after(target: DataFrame, resolved: DataFrame) -> DataFrame:
    """The index once the resolved operations, each path changed once, have taken effect."""
    took = resolved.where(EFFECTIVE)
    arrived = took.where("outcome = 'moved'").selectExpr(
        "to_path AS path", "old_content_hash AS content_hash"
    )
    left = target.join(took.selectExpr("from_path AS path"), "path", "left_anti")
    return left.select("path", "content_hash").unionByName(arrived)


# One row per operation and path: what it leaves there if it takes effect.
_TOUCHES = """inline(filter(array(
    struct('old' AS role, from_path AS path, false AS present, CAST(NULL AS STRING) AS hash),
    struct('new' AS role, to_path AS path, true AS present, old_content_hash AS hash)
  ), t -> t.path IS NOT NULL))"""


def _before(touches: DataFrame, first: int, width: int) -> DataFrame:
    """``touches`` with ``before``: the last effective write to the path ahead of each of them.

    A path's touches are cut into ranges of the order, so that no task holds a path that many
    operations name. Within a range the last write is a running maximum, and so it is over the
    at most ``CHUNKS`` ranges of a path.
    """
    writes = touches.selectExpr(
        "*",
        f"(idx - {first}) div {width} AS chunk",
        "CASE WHEN assumed THEN struct(idx AS writer, present, hash) END AS write",
    )
    ahead = Window.partitionBy("path", "chunk").orderBy("idx").rangeBetween(
        Window.unboundedPreceding, -1  # not the operation's own other path, if that is the same
    )
    chunks = writes.groupBy("path", "chunk").agg(F.max("write").alias("last"))
    earlier = Window.partitionBy("path").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = chunks.select("path", "chunk", F.max("last").over(earlier).alias("carried"))
    return (
        writes.withColumn("near", F.max("write").over(ahead))
        .join(carried, ["path", "chunk"])
        .selectExpr("idx", "role", "path", "coalesce(near, carried) AS before")
    )


def _evaluated(marked: DataFrame, index: DataFrame) -> DataFrame:
    """Outcome of every operation if those ``assumed`` take effect and no others do.

    With it come the operations that wrote what was found at the two paths, and the outcomes
    if one of these two had not taken effect.
    """
    span = marked.agg(F.min("idx").alias("low"), F.max("idx").alias("high")).first()
    first = span.low - 1  # the index is what stood there before the first operation
    width = -(-(span.high - first + 1) // CHUNKS)
    start = index.selectExpr(
        f"CAST({first} AS BIGINT) AS idx", "true AS assumed", "'start' AS role", "path",
        "true AS present", "content_hash AS hash",
    )
    touches = marked.selectExpr("idx", "assumed", _TOUCHES).unionByName(start)
    found = materialize(_before(touches, first, width), "operations-before")
    # What the writer itself found there is what would still be there without it.
    prior = found.selectExpr("idx AS writer", "path", "before AS prior")
    sides = (
        found.where("role <> 'start'")
        .withColumn("writer", F.expr("coalesce(before.writer, -1 - idx)"))
        .join(prior, ["writer", "path"], "left")
        .groupBy("idx")
        .agg(
            *[
                F.max(F.when(F.col("role") == side, F.struct("before", "prior"))).alias(side)
                for side in ("old", "new")
            ]
        )
    )
    by = [f"nullif({side}.before.writer, {first}) AS {side}_writer" for side in ("old", "new")]
    outcomes = {
        "outcome": _outcome("old.before", "new.before"),
        "without_old": _outcome("old.prior", "new.before"),
        "without_new": _outcome("old.before", "new.prior"),
    }
    return marked.join(sides, "idx").selectExpr(
        *marked.columns, *by, *[f"{sql} AS {name}" for name, sql in outcomes.items()]
    )


def _followed(evaluated: DataFrame) -> DataFrame:
    """``idx, assumed`` for the next pass: new verdicts, carried on to what hangs on them.

    An operation hangs on the writer without which it would end otherwise. Its verdict is then a
    function of that one's, ``if_so`` or ``if_not``; functions are composed along the writers by
    pointer jumping, so a chain of n operations takes log n steps.
    """
    verdict, without = f"({EFFECTIVE})", "{0} IN ('moved', 'deleted')"
    flips = {
        side: f"{side}_writer IS NOT NULL AND ({without.format('without_' + side)}) <> {verdict}"
        for side in ("old", "new")
    }
    links = evaluated.selectExpr(
        "idx",
        f"CASE WHEN {flips['old']} THEN old_writer WHEN {flips['new']} THEN new_writer END AS on",
        f"{verdict} AS if_so",
    ).selectExpr("idx", "on", "if_so", "CASE WHEN on IS NULL THEN if_so ELSE NOT if_so END AS if_not")
    links = materialize(links, "operations-links")
    while not links.where("on IS NOT NULL").isEmpty():
        above = links.selectExpr("idx AS up", "on AS next", "if_so AS yes", "if_not AS no")
        hanging = links.where("on IS NOT NULL").join(above, F.expr("on = up"))
        jumped = hanging.selectExpr(
            "idx", "next AS on", "CASE WHEN yes THEN if_so ELSE if_not END AS if_so",
            "CASE WHEN no THEN if_so ELSE if_not END AS if_not",
        )
        links = materialize(links.where("on IS NULL").unionByName(jumped), "operations-links")
    return links.selectExpr("idx", "if_so AS assumed")


def _ordered(ops: DataFrame, index: DataFrame) -> DataFrame:
    """Outcomes of operations that share paths, as if applied one after the other by ``idx``.

    All are first assumed to take effect. A pass then evaluates every operation against what the
    assumed ones before it leave behind. If no verdict differs from what was assumed, all of
    them are right, as each follows from those before it. Else the verdicts, carried on along
    chains, are the next assumption; at least the first wrong one is right from then on. So the
    number of passes follows how often a surprise changes what comes later, and not how long
    chains are or how many operations name a path. Each step is written to the shared folder.
    """
    columns = ["idx", "operation", "from_path", "to_path", "old_content_hash", "new_content_hash"]
    assumed = ops.select("idx").withColumn("assumed", F.lit(True))
    while True:
        marked = materialize(ops.select(*columns).join(assumed, "idx"), "operations-assumed")
        evaluated = materialize(_evaluated(marked, index), "operations-evaluated")
        if evaluated.where(f"assumed <> ({EFFECTIVE})").isEmpty():
            return evaluated.select("idx", "outcome")
        assumed = _followed(evaluated)


def apply_operations(operations: DataFrame, target: DataFrame, root: str) -> DataFrame:
    """Each operation with its ``outcome`` and whether it ``needed_ordering``.

    ``operations`` carries a unique ``idx``; ``target`` is ``path, content_hash`` with
    absolute paths, one row per path. Operations that share no path with another one, the
    normal case, are resolved in one set-based pass. The rest (chains, swaps, replays, many
    moves to one place) is settled in passes over all of them, see ``_ordered``.
    """
    keep = operations.columns
    ops = operations.selectExpr(
        "*",
        f"{target_path(root, 'old_path')} AS from_path",
        f"CASE WHEN operation = 'move' THEN {target_path(root, 'new_path')} END AS to_path",
    )
    touches = ops.selectExpr("idx", _PATHS)
    shared = touches.groupBy("path").agg(F.expr("min(idx) < max(idx) AS is_shared"))
    entangled = (
        touches.join(shared.where("is_shared"), "path", "left_semi").select("idx").distinct()
    )
    alone = _resolve(ops.join(entangled, "idx", "left_anti"), target)
    done = alone.selectExpr(*keep, "outcome", "false AS needed_ordering")
    pending = materialize(ops.join(entangled, "idx", "left_semi"), "pending-operations")
    if pending.isEmpty():
        return done
    paths = pending.selectExpr(_PATHS).distinct()
    index = materialize(
        target.select("path", "content_hash").join(paths, "path", "left_semi"), "target-index"
    )
    settled = pending.join(_ordered(pending, index), "idx")
    return done.unionByName(settled.selectExpr(*keep, "outcome", "true AS needed_ordering"))
