"""Folders that batches write to, read before anything may have been written."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_written(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The table in ``folder``; no rows if it is not there yet."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
