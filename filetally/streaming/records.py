"""File records and checkpoints as streams.

Both keep what they have settled beside their output, by batch: a batch that is repeated reads
what it read the first time and writes the same again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from filetally.operators.keyed import dedupe_replay
from filetally.schemas import LONG, STRING, struct
from filetally.session import materialize
from filetally.sources.records import WRITTEN, plan_writes
from filetally.sources.written import read_written

LEDGER = struct(idx=LONG, destination_path=STRING, outcome=STRING, batch_id=LONG)
FAILURES = struct(run=STRING, first_failure=LONG, batch_id=LONG)
ENDED = "outcome IN ('invalid', 'conflict')"


def settle_batch(
    validated: DataFrame,
    batch_id: int,
    target: str,
    policy: str = "overwrite",
    existing: DataFrame | None = None,
) -> None:
    """Write one batch of an ordered run and enter its records in the ledger.

    Records that the ledger holds are replays and left out. Under the fail policy a path is
    taken if ``existing`` holds it or an earlier batch wrote it. A run that an earlier batch
    ended, by an invalid record or a conflict, goes no further.
    """
    spark = validated.sparkSession
    ledger = read_written(spark, f"{target}/ledger", LEDGER).where(F.col("batch_id") < batch_id)
    batch = materialize(validated, "record-batch")
    # The ledger is narrow, and its files hold the indexes of a batch each: the bounds prune them.
    span = batch.agg(F.min("idx").alias("low"), F.max("idx").alias("high")).first()
    settled = ledger.where(F.col("idx").between(span.low, span.high)).select("idx").distinct()
    fresh = batch.join(settled, "idx", "left_anti")
    stop = ledger.where(ENDED).agg(F.min("idx")).first()[0]
    if stop is not None:
        plan = fresh.selectExpr("idx", "destination_path", "'not_reached' AS outcome")
    else:
        taken = None
        if policy == "fail":
            taken = ledger.where("outcome = 'written'").select("destination_path")
            if existing is not None:
                taken = taken.unionByName(existing.select("destination_path"))
        plan = plan_writes(fresh, taken, policy)
    plan = materialize(plan, "batch-plan")
    # The bytes meet the indexes alone, once: where these are few, they are broadcast by their
    # measured size and the bytes stay in place. A plan's paths would hide how few they are.
    winners = materialize(plan.where("outcome = 'written'").select("idx"), "batch-winners")
    files = batch.select(*WRITTEN).join(winners, "idx", "left_semi")
    files.write.mode("overwrite").parquet(f"{target}/files/batch_id={batch_id}")
    plan.write.mode("overwrite").parquet(f"{target}/ledger/batch_id={batch_id}")


def start_record_stream(
    validated: DataFrame,
    target: str,
    checkpoint: str,
    policy: str = "overwrite",
    existing: DataFrame | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write a stream of validated records, which come in the order of their ``idx``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        settle_batch(batch, batch_id, target, policy, existing)

    return _started(validated, run, checkpoint, trigger)


def read_ledger(spark: SparkSession, target: str) -> DataFrame:
    """``idx, destination_path, outcome`` of every record; a later batch supersedes a path."""
    ledger = read_written(spark, f"{target}/ledger", LEDGER).drop("batch_id")
    last = (
        ledger.where("outcome = 'written'")
        .groupBy("destination_path")
        .agg(F.max("idx").alias("last"))
        .withColumnRenamed("destination_path", "of")
    )
    outcome = "CASE WHEN outcome = 'written' AND idx < last THEN 'superseded' ELSE outcome END"
    return ledger.join(last, F.expr("destination_path = of"), "left").selectExpr(
        "idx", "destination_path", f"{outcome} AS outcome"
    )


def read_records(spark: SparkSession, target: str) -> DataFrame:
    """The files that the target holds: of each path the last one written."""
    current = read_ledger(spark, target).where("outcome = 'written'").select("idx")
    return spark.read.parquet(f"{target}/files").drop("batch_id").join(current, "idx", "left_semi")


def gate_batch(log: DataFrame, batch_id: int, target: str) -> None:
    """Release the batch's checkpoints up to the first failure of their run, seen so far.

    ``log`` has ``run, idx, kind, failed``, and a run's rows come in order. Kept is one row for
    every run that has failed, so the state grows with failures and not with the log.
    """
    spark = log.sparkSession
    batch = materialize(log.withColumn("run", F.col("run").cast("string")), "gate-batch")
    known = read_written(spark, f"{target}/failures", FAILURES)
    known = known.where(F.col("batch_id") < batch_id).select("run", "first_failure")
    failed = (
        batch.where("kind = 'record' AND failed")
        .groupBy("run")
        .agg(F.min("idx").cast("long").alias("first_failure"))
    )
    failed.join(known.select("run"), "run", "left_anti").write.mode("overwrite").parquet(
        f"{target}/failures/batch_id={batch_id}"
    )
    first = read_written(spark, f"{target}/failures", FAILURES)
    first = first.where(F.col("batch_id") <= batch_id).groupBy("run").agg(
        F.min("first_failure").alias("first_failure")
    )
    released = F.expr("first_failure IS NULL OR idx < first_failure")
    checkpoints = batch.where("kind = 'state'").join(first, "run", "left")
    checkpoints.withColumn("released", released).drop("first_failure").write.mode(
        "overwrite"
    ).parquet(f"{target}/checkpoints/batch_id={batch_id}")


def start_gate_stream(
    log: DataFrame, target: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Release checkpoints as they arrive; ``read_checkpoints`` has what is settled."""

    def run(batch: DataFrame, batch_id: int) -> None:
        gate_batch(batch, batch_id, target)

    return _started(log, run, checkpoint, trigger)


def read_checkpoints(spark: SparkSession, target: str) -> DataFrame:
    """Every checkpoint with whether it was ``released``; one that came twice counts once."""
    rows = spark.read.parquet(f"{target}/checkpoints")
    return dedupe_replay(rows, ["run", "idx"], ["batch_id"]).drop("batch_id")


def _started(stream, run, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
