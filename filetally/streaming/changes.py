"""The change log as a stream of landed pages.

The query's checkpoint is the cursor: it moves past a page only after the batch that holds
it was written whole, and a failed page is read again. Batches are written to their own
``batch_id`` folder in overwrite mode, so repeating one changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from filetally.operators.keyed import dedupe_replay
from filetally.operators.relations import entries
from filetally.session import materialize
from filetally.sources.keyed_table import KeyedTable

ORDER = ["page", "ordinal"]


def start_change_stream(
    listing: DataFrame, target: str, checkpoint: str, mapper=None, trigger: dict | None = None
) -> StreamingQuery:
    """Append each page's change-log rows, with their page and ordinal, below ``target``.

    ``mapper`` may reshape a batch (DataFrame to DataFrame) before it is written. Without a
    ``trigger`` the query takes what has landed and ends.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = mapper(batch) if mapper else batch
        rows.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    log = entries_with_order(listing)
    return (
        log.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def entries_with_order(listing: DataFrame) -> DataFrame:
    """Change-log rows that keep the page and ordinal they came from."""
    return entries(listing, keep=ORDER)


def read_changes(spark: SparkSession, target: str, schema=None) -> DataFrame:
    """All committed batches of the change log."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(target).drop("batch_id")


def current_entries(changes: DataFrame) -> DataFrame:
    """Latest row per key: replayed pages collapse, genuine updates win by order.

    The log is append-only and collapses on read in one partial aggregate, so a micro-batch
    never rewrites what earlier batches wrote.
    """
    return dedupe_replay(changes, ["entry_key"], ORDER)


def entry_view(listing: DataFrame, path: str, buckets: int = 64) -> KeyedTable:
    """The table of latest change-log rows that ``start_view_stream`` keeps for ``listing``."""
    return KeyedTable(path, entries_with_order(listing).schema, ["entry_key"], ORDER, buckets)


def start_view_stream(
    listing: DataFrame, view: KeyedTable, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the latest row per key up to date: a page touches the buckets of its keys alone.

    ``current_entries`` collapses the whole log on each read; this reads what is kept. Replayed
    pages change nothing, and later rows win by order, whichever batch brings them.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = materialize(batch, "view-batch")
        view.merge(rows, batch_id)

    return (
        entries_with_order(listing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
