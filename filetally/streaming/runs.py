"""Pages gathered to the end of their cursor run.

A listing answers in pages, and only the page after which no more follow ends what a cursor
covers. A rename may put its new path on one page and the tombstone of its old path on another,
so a delta is planned from a whole run. Until that ends, pages wait below ``pages``, each
written once by the batch it came in; ``runs`` holds one row for every batch that ended a run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filetally.schemas import LISTING_PAGE, LONG, STRING, struct
from filetally.sources.listing import flatten_pages
from filetally.sources.written import read_written

ENDED = struct(closed=LONG, cursor=STRING, batch_id=LONG)
STORED = T.StructType([*LISTING_PAGE.fields, T.StructField("batch_id", LONG)])


@dataclass(frozen=True)
class Run:
    """The rows of all pages since the run before, the last page and its cursor."""

    rows: DataFrame
    closed: int
    cursor: str | None


def gather_run(pages: DataFrame, batch_id: int, target: str) -> Run | None:
    """Keep the batch's pages; if with them a run is whole, all pages up to its end.

    Pages are numbered from 0 without gaps, in the order of the listing; they may land in any
    order, and a run is whole once none is missing. A page that does not say whether more
    follow ends its run. Several runs that end in one batch are one: it is what a later call
    with the older cursor would have returned. Pages of an ended run are replays and left out;
    of a page that landed again, the later copy counts.
    """
    spark = pages.sparkSession
    pages.select(*LISTING_PAGE.names).write.mode("overwrite").parquet(
        f"{target}/pages/batch_id={batch_id}"
    )
    ended = read_written(spark, f"{target}/runs", ENDED).where(F.col("batch_id") < batch_id)
    last = ended.orderBy(F.desc("batch_id")).first()
    closed = last.closed if last else -1
    stored = read_written(spark, f"{target}/pages", STORED)
    waiting = stored.where((F.col("page") > closed) & (F.col("batch_id") <= batch_id))
    # Numbers only: the last page before the first gap, then the last one there that ends a run.
    numbers = waiting.select("page").distinct()
    unfollowed = numbers.join(numbers.selectExpr("page - 1 AS page"), "page", "left_anti")
    if numbers.agg(F.min("page")).first()[0] != closed + 1:
        return None
    reach = unfollowed.agg(F.min("page")).first()[0]
    end = (
        waiting.where((F.col("page") <= reach) & ~F.coalesce("has_more", F.lit(False)))
        .agg(F.max("page").alias("page"), F.expr("max_by(cursor, page) AS cursor"))
        .first()
    )
    if end.page is None:
        return None
    whole = waiting.where(F.col("page") <= end.page)
    newest = whole.groupBy("page").agg(F.max("batch_id").alias("batch_id"))
    copies = whole.join(newest, ["page", "batch_id"], "left_semi")
    return Run(flatten_pages(copies), end.page, end.cursor)


def end_run(run: Run, spark: SparkSession, batch_id: int, target: str) -> None:
    """Remember how far the plans have come; written after everything else of the batch."""
    row = spark.createDataFrame([(run.closed, run.cursor)], "closed long, cursor string")
    row.coalesce(1).write.mode("overwrite").parquet(f"{target}/runs/batch_id={batch_id}")
