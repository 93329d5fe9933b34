"""Small helpers shared by the operators: table access, folds and working columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filetally.session import materialize

__all__ = ["fold", "materialize", "read", "texts"]


def read(spark: SparkSession, tables: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{tables}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator works on, so that others cannot clash with its own."""
    return docs.select("doc_id", "text", *more)


def fold(parts: int, id_column: str = "doc_id") -> Column:
    """``crc32`` of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % parts
