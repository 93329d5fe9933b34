"""From raw documents to a weighted training order, in five stages.

``STAGES`` lists them as (name, function). A function takes (spark, docs, sf_dir), where docs
are the rows that its predecessor kept, and returns a DataFrame; it is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents, whatever
these are, with texts unchanged; rows of one id and text share their fate, except that of near
duplicates one stays. Rows without id or text are judged like others, very long texts whole,
and an empty table passes through as one. ``ORACLE_SQL`` is None, as SQL cannot express the boosted trees of the first stage;
the tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filetally.llm.common import materialize, read
from filetally.llm.decontaminate import find_contamination
from filetally.llm.mixing import mix_sources
from filetally.llm.ngram_join import Rule, near_duplicates
from filetally.llm.quality_rules import assess
from filetally.llm.toxicity import keep_clean

ORACLE_SQL = None


MOST_BROADCAST = 1_000_000  # rejected rows' keys, of 16 bytes; more are joined by a shuffle


def _without(docs: DataFrame, rejected: DataFrame, most_broadcast: int) -> DataFrame:
    """Rows of ``docs`` that are not among ``rejected`` (doc_id, digest of the text).

    A verdict follows from a row's text. Id and digest have to agree, a null id with a null id,
    so a clean text can only be taken for a rejected one of the same id.
    """
    keys = rejected.selectExpr("doc_id AS rejected_id", "digest AS rejected_digest").distinct()
    keys = materialize(keys, "pipeline-rejected")
    if keys.count() <= most_broadcast:  # texts stay in place
        keys = F.broadcast(keys)
    same = F.expr("doc_id <=> rejected_id AND xxhash64(text) <=> rejected_digest")
    return docs.join(keys, same, "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not call toxic, judged where they are."""
    return keep_clean(docs, read(spark, sf_dir, "labels"))


def drop_low_quality(
    spark: SparkSession, docs: DataFrame, sf_dir: str, most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts are none."""
    judged = materialize(assess(docs).select("doc_id", "digest", "kept"), "pipeline-quality")
    return _without(docs, judged.where("NOT kept"), most_broadcast)


def drop_near_duplicates(
    spark: SparkSession, docs: DataFrame, sf_dir: str, most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Rows that repeat an id are one document, of which one row stays; rows without an id stay.
    """
    found = near_duplicates(docs, Rule(words=5, percent=80))
    copies = found.where("doc_id <> component_id").selectExpr("doc_id AS copy").distinct()
    copies = materialize(copies, "pipeline-copies")
    if copies.count() <= most_broadcast:
        copies = F.broadcast(copies)
    one = docs.join(copies, F.expr("doc_id = copy"), "left_anti")
    repeated = one.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    again = materialize(repeated.select("doc_id"), "pipeline-repeated")
    if again.isEmpty():
        return one
    first = one.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return one.join(again, "doc_id", "left_anti").unionByName(first)


def drop_contaminated(
    spark: SparkSession, docs: DataFrame, sf_dir: str, most_broadcast: int = MOST_BROADCAST
) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    found = find_contamination(docs, read(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated"), most_broadcast)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order, with sources at their target weights."""
    return mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, from the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
