"""Reconciliation reports on disk: sorted JSON lines and a summary.

A distributed write has no last line, so details and summary are two datasets below one
path. Reading also accepts a single file that ends with its summary row; lines can be numbered
through all files, which shows whether it does.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filetally.errors import ContractError
from filetally.guards import passes
from filetally.operators.reconcile import SUMMARY_COUNTERS, as_summary
from filetally.schemas import REPORT, SUMMARY

FLAT_SUMMARY = ", ".join(f"{counter.split(' AS ')[1]} long" for counter in SUMMARY_COUNTERS)


class Report(NamedTuple):
    details: DataFrame
    summary: DataFrame


def write_report(details: DataFrame, path: str) -> None:
    """Write the details sorted, then the summary, whose presence completes the report.

    ``path`` has to be new: over an older report, its summary would vouch for half a new one.
    The totals are observed while the sorted details pass by on their way to the sink and need
    no pass of their own. Spark samples the details first to choose the sort ranges, so pass
    a written relation if computing them is dear.
    """
    # Issues may share a place in the listing; their ids then decide.
    tie = ["sort_key", "path", "source.file_id", "destination.file_id"]
    ordered = details.orderBy(*tie).drop("sort_key")
    totals = Observation("report")
    counters = [F.expr(counter) for counter in SUMMARY_COUNTERS]
    ordered.observe(totals, *counters).write.json(f"{path}/details")
    flat = details.sparkSession.createDataFrame([totals.get], FLAT_SUMMARY)
    as_summary(flat).coalesce(1).write.json(f"{path}/summary")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a report with declared types and, if one does not fit, its text."""
    fields = {f.name: f for f in [*REPORT.fields, *SUMMARY.fields]}
    schema = T.StructType([*fields.values(), T.StructField("_corrupt_record", T.StringType())])
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a report; one that does not fit fails the job."""
    lines = _lines(spark, path)
    return lines.where(passes("_corrupt_record IS NULL", "'Report must be valid JSON lines.'"))


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines straight from a scan, with their number through all files in the order of names.

    A task reads a block of a file from its offset on, so a line's place in the block is known
    where it is read. What came before the block is the sum of the blocks before: one row a
    block, which is what a task reads.
    """
    placed = lines.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_place": F.monotonically_increasing_id(),
        }
    )
    blocks = placed.groupBy("_file", "_block").agg(
        F.count("*").alias("n"), F.min("_place").alias("first")
    )
    shifts, total = [], 0
    for block in blocks.orderBy("_file", "_block").collect():
        shifts.append((block._file, block._block, total - block.first + 1))
        total += block.n
    known = lines.sparkSession.createDataFrame(shifts, "_file string, _block long, _shift long")
    return (
        placed.join(F.broadcast(known), ["_file", "_block"])
        .withColumn("line", F.expr("_place + _shift"))
        .drop("_file", "_block", "_place", "_shift")
    )


_IS_SUMMARY = "coalesce(type = 'summary', false)"


def report_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines of a stored report with their ``line`` number, from 1.

    The details of the two-dataset form come first, in their order, then the summary.
    """
    try:
        details = _numbered(_lines(spark, f"{path}/details"))
        summary = _lines(spark, f"{path}/summary").withColumn("line", F.lit(details.count() + 1))
        numbered = details.unionByName(summary)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        numbered = _numbered(_lines(spark, path))
    return numbered.where(passes("_corrupt_record IS NULL", "'Report must be valid JSON lines.'"))


def order_violations(lines: DataFrame) -> DataFrame:
    """``rule, rows`` for what breaks the order of a report: rows that follow its summary."""
    ends = lines.where(_IS_SUMMARY).agg(F.min("line")).scalar()
    after = lines.where(f"NOT {_IS_SUMMARY}").where(F.col("line") > ends)
    counted = after.agg(F.count("*").alias("rows")).where("rows > 0")
    return counted.selectExpr("'row_after_summary' AS rule", "rows")


def read_report(spark: SparkSession, path: str) -> Report:
    """Details and summary; the latter must be exactly one row.

    Of the two-dataset form only the summary is read here, whatever the details' size.
    """
    try:
        summary, details = _rows(spark, f"{path}/summary"), _rows(spark, f"{path}/details")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        summary = details = _rows(spark, path)
    summary = summary.where(_IS_SUMMARY).select(*SUMMARY.names)
    if len(summary.select("type").take(2)) != 1:
        raise ContractError("Report must hold exactly one summary record.")
    return Report(details.where(f"NOT {_IS_SUMMARY}").select(*REPORT.names), summary)
