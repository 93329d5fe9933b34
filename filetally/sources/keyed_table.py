"""Latest row per key as a table of buckets that batches replace one by one.

A key's bucket is a hash of it. A batch merges its rows into the buckets of its keys, writes
those anew and, last, a manifest that names them; all other buckets stay as they are. A reader
takes the newest version of each bucket. So a batch reads and writes what its keys' buckets
hold and not the whole table, and repeating a batch writes the same versions again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filetally.operators.keyed import dedupe_replay
from filetally.schemas import LONG, struct
from filetally.sources.written import read_written

MANIFEST = struct(bucket=LONG, batch_id=LONG)


@dataclass(frozen=True)
class KeyedTable:
    """``order`` says which row of a key is the latest; ``buckets`` is fixed once written."""

    path: str
    schema: T.StructType
    key: Sequence[str]
    order: Sequence[str]
    buckets: int = 64
    spread: Sequence[str] | None = None  # the columns of the key that choose the bucket

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*(self.spread or self.key)), F.lit(self.buckets))

    def _versions(self, spark: SparkSession, before: int | None) -> dict[int, int]:
        """Newest batch of each bucket, at most one entry a bucket."""
        named = read_written(spark, f"{self.path}/manifest", MANIFEST)
        if before is not None:
            named = named.where(F.col("batch_id") < before)
        newest = named.groupBy("bucket").agg(F.max("batch_id").alias("batch_id"))
        return {r.bucket: r.batch_id for r in newest.collect()}

    def read(
        self, spark: SparkSession, before: int | None = None, only: Iterable[int] | None = None
    ) -> DataFrame:
        """The latest rows, of all buckets or ``only`` some, as of a batch."""
        versions = self._versions(spark, before)
        wanted = versions if only is None else [b for b in only if b in versions]
        folders = [f"{self.path}/rows/batch_id={versions[b]}/bucket={b}" for b in wanted]
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*folders)

    def lookup(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """The latest rows of ``keys``, read from their buckets alone.

        ``keys`` has the columns of the key, or at least those that choose the bucket.
        """
        spark = keys.sparkSession
        given = [c for c in self.key if c in keys.columns]
        named = keys.select(self.bucket_of().alias("bucket")).distinct().collect()
        found = self.read(spark, before, sorted(r.bucket for r in named))
        return found.join(keys.select(*given).distinct(), given, "left_semi")

    def merge(self, rows: DataFrame, batch_id: int) -> None:
        """Lay the rows over what earlier batches left, in the buckets of their keys."""
        spark = rows.sparkSession
        touched = [r.bucket for r in rows.select(self.bucket_of().alias("bucket")).distinct().collect()]
        if not touched:
            return
        present = self.read(spark, batch_id, touched)
        # Replayed pages collapse by key before they meet what is stored.
        merged = dedupe_replay(
            present.unionByName(rows.select(*self.schema.names)), self.key, self.order
        )
        merged.withColumn("bucket", self.bucket_of()).repartition("bucket").write.partitionBy(
            "bucket"
        ).mode("overwrite").parquet(f"{self.path}/rows/batch_id={batch_id}")
        names = spark.createDataFrame([(b,) for b in touched], "bucket long")
        names.coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/manifest/batch_id={batch_id}"
        )
