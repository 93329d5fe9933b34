"""Labelled rows to fit a classifier on: a bounded sample, spread over the ids by a hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.llm.common import fold

LIMIT = 20_000  # labelled rows at most; the only bound on what a classifier sees


def training_labels(labels: DataFrame, name: str, parts: int = 5, limit: int = LIMIT) -> DataFrame:
    """``(label_id, label)`` of at most ``limit`` ids outside fold 0, the same on every run.

    Labels other than 0 and 1 are left out; an id labelled more than once takes the larger one.
    """
    return (
        labels.where(fold(parts) != 0)
        .where(F.col(name).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max(name).cast("int").alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(limit)
    )


def labelled_texts(docs: DataFrame, labels: DataFrame, name: str, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, text, label)`` of the sample; its ids are broadcast, at most ``limit`` rows."""
    wanted = F.broadcast(training_labels(labels, name, limit=limit))
    return docs.join(wanted, docs.doc_id == wanted.label_id).select("doc_id", "text", "label")
