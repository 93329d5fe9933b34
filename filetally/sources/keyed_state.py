"""Version state in buckets of ids and of folded paths, so that a delta reads what it names.

The rows are two tables: versions by file id, and file ids by folded path. A batch rewrites the
buckets of the ids and paths it changes; a plan reads those of the ids and tombstones it names.
Headers are those of the other layout.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filetally.functions.paths import fold
from filetally.schemas import BOOLEAN, LONG, STRING, TRANSFER_STATE, struct
from filetally.session import materialize
from filetally.sources.keyed_table import KeyedTable

_MARKS = [T.StructField("removed", BOOLEAN), T.StructField("version", LONG)]
BY_ID = T.StructType([*TRANSFER_STATE.fields, *_MARKS])
BY_PATH = T.StructType([*struct(folded=STRING, file_id=STRING).fields, *_MARKS])


@dataclass(frozen=True)
class KeyedState:
    """Rows of a transfer state below ``path``; ``buckets`` is fixed once written."""

    path: str
    buckets: int = 64

    @cached_property
    def by_id(self) -> KeyedTable:
        return KeyedTable(f"{self.path}/by_id", BY_ID, ["file_id"], ["version"], self.buckets)

    @cached_property
    def by_path(self) -> KeyedTable:
        key = ["folded", "file_id"]
        return KeyedTable(
            f"{self.path}/by_path", BY_PATH, key, ["version"], self.buckets, spread=("folded",)
        )

    def files(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """All rows of the state."""
        return _present(self.by_id.read(spark, before))

    def named(
        self, changed: DataFrame, tombstones: DataFrame, before: int | None = None
    ) -> DataFrame:
        """The rows that a delta can touch: its ids, and the ids at its tombstones' paths."""
        dead = tombstones.selectExpr(f"{fold('path')} AS folded").distinct()
        dead = materialize(dead, "state-tombstones")
        gone = self.by_path.lookup(dead, before).where("NOT removed")
        ids = changed.select("file_id").unionByName(gone.select("file_id")).distinct()
        return _present(self.by_id.lookup(materialize(ids, "state-ids"), before))

    def merge(self, changes: DataFrame, version: int) -> None:
        """Lay the changed rows (with ``removed``) of one version over those before."""
        changes = materialize(
            changes.select(*TRANSFER_STATE.names, "removed")
            .withColumn("version", F.lit(version).cast("long")),
            "state-changes",
        )
        before = _present(self.by_id.lookup(changes.select("file_id"), version))
        left = before.selectExpr("file_id", f"{fold('path')} AS folded", "true AS removed")
        come = changes.where("NOT removed").selectExpr(
            "file_id", f"{fold('path')} AS folded", "false AS removed"
        )
        # A path that stays is both left and come to: coming counts.
        paths = left.unionByName(come).groupBy("folded", "file_id").agg(
            F.min("removed").alias("removed")
        )
        paths = paths.withColumn("version", F.lit(version).cast("long"))
        self.by_path.merge(materialize(paths, "state-paths"), version)
        self.by_id.merge(changes, version)


def _present(rows: DataFrame) -> DataFrame:
    return rows.where("NOT removed").select(*TRANSFER_STATE.names)
