"""Mixing sources to target weights by temperature.

Every source's share of the tokens is raised to an exponent and normalised: 1 keeps the
shares, 0 makes them equal. The exponent is bisected on a fixed grid, to the smallest one at
which no source is repeated more than allowed, or to the largest one at which the entropy of
the weights reaches a target. A source's weight of the token budget is then realised as whole
blocks, each a new permutation of the source, and the beginning of one more.

A permutation is the order of a hash of block and document. Its beginning is found without
sorting a source: hash ranges are summed first, and only the range in which the budget ends
is put in order.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filetally.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"
GRID = 1 << 12  # steps of the exponent between 0 and 1
KEY_BITS = 60  # of the hash that orders a permutation
RANGE_ROWS = 4096  # documents in a hash range, about


@dataclass(frozen=True)
class Target:
    """Budget as a share of all tokens, and what the exponent has to meet."""

    budget: float = 1.0
    repeats: float | None = 1.25  # a source is seen so often at most
    entropy: float | None = None  # of the weights, as a part of the greatest possible
    seed: str = "0"


def sources_of(docs: DataFrame) -> DataFrame:
    """Tokens and documents by source."""
    return docs.groupBy("source").agg(
        F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs")
    )


def find_exponent(sources: DataFrame, target: Target) -> float:
    """Bisect the exponent; each step reads two sums over the table of sources."""
    sources = sources.where("tokens > 0")
    total, count = sources.agg(F.sum("tokens"), F.count("*")).first()
    if not count:
        return 1.0
    share = F.col("tokens") / F.lit(total)

    def meets(step: int) -> bool:
        power = F.pow(share, F.lit(step / GRID))
        whole, spread, most = sources.agg(
            F.sum(power), F.sum(power * F.log(power)), F.max(power / F.col("tokens"))
        ).first()
        if target.entropy is not None:
            return log(whole) - spread / whole >= target.entropy * log(count)
        return target.repeats is None or most / whole * target.budget * total <= target.repeats

    # Repeats fall and entropy falls as the exponent grows, so one limit is met from some step
    # on and the other up to some step.
    low, high = 0, GRID
    if target.entropy is not None:
        if meets(GRID):
            return 1.0
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if meets(middle) else (low, middle)
        return low / GRID
    if meets(0):
        return 0.0
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if meets(middle) else (middle, high)
    return high / GRID


def weights(sources: DataFrame, exponent: float, target: Target) -> DataFrame:
    """Weight, whole blocks and tokens of the last block of each source."""
    used = sources.where("tokens > 0")
    total = used.agg(F.sum("tokens")).first()[0] or 1
    power = F.pow(F.col("tokens") / F.lit(total), F.lit(exponent))
    whole = used.agg(F.sum(power)).first()[0] or 1.0
    wanted = F.floor(power / F.lit(whole) * F.lit(target.budget * total) + 0.5)
    return used.select(
        "source",
        "tokens",
        "n_docs",
        F.round(power / F.lit(whole), 9).alias("weight"),
        (wanted / F.col("tokens")).cast("long").alias("blocks"),
        (wanted % F.col("tokens")).cast("long").alias("rest"),
    )


def order_key(seed: str, block) -> F.Column:
    """Place of a document in a block's permutation."""
    text = F.concat_ws(
        "/", F.lit(seed), block.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    )
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def mix_sources(docs: DataFrame, target: Target = Target()) -> DataFrame:
    """Training order of ``docs`` (doc_id, text, source): one row per document and block.

    Columns: doc_id, source, n_tokens, weight, block, order_key; sorted by block and key they
    are the order in which to read. Of the last block, documents are taken while those before
    them hold fewer tokens than the budget left. A null source is a source of its own. Documents
    without tokens (null and empty texts) take part in no block; an empty table gives an empty
    result. Equal keys go by id; repeated rows are documents of their own. Sources fit their
    targets to within one document.
    """
    counted = materialize(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
        ).where("n_tokens > 0"),
        "mixing-tokens",
    )
    sources = materialize(sources_of(counted), "mixing-sources")
    exponent = find_exponent(sources, target)
    plan = materialize(weights(sources, exponent, target), "mixing-weights")
    placed = counted.alias("d").join(
        plan.select(F.col("source").alias("of"), "weight", "blocks", "rest", "n_docs"),
        F.expr("source <=> of"),
    )
    whole = placed.where("blocks > 0").select(
        "doc_id",
        "source",
        "n_tokens",
        "weight",
        F.explode_outer(F.expr("sequence(0L, blocks - 1)")).alias("block"),
    )
    whole = whole.withColumn("order_key", order_key(target.seed, F.col("block")))

    ranges = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / RANGE_ROWS)).cast("double")
    last = (
        placed.where("rest > 0")
        .withColumn("block", F.col("blocks"))
        .withColumn("order_key", order_key(target.seed, F.col("blocks")))
        .withColumn("part", F.floor(F.col("order_key") / F.lit(float(1 << KEY_BITS)) * ranges))
        .select("doc_id", "source", "n_tokens", "weight", "block", "order_key", "part", "rest")
    )
    by_part = last.groupBy("source", "part", "rest").agg(F.sum("n_tokens").alias("tokens"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        by_part.withColumn("before", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
        .where("before < rest")
        .select(
            F.col("source").alias("of"),
            F.col("part").alias("of_part"),
            "before",
            (F.col("before") + F.col("tokens") > F.col("rest")).alias("cut"),
        )
    )
    reached = last.join(ends, F.expr("source <=> of AND part = of_part"))
    columns = ["doc_id", "source", "n_tokens", "weight", "block", "order_key"]
    inside = (
        Window.partitionBy("source", "part")
        .orderBy("order_key", "doc_id", "n_tokens")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    cut = reached.where("cut").withColumn(
        "sum_before", F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    )
    return (
        whole.select(columns)
        .unionByName(reached.where("NOT cut").select(columns))
        .unionByName(cut.where("sum_before < rest").select(columns))
    )


SQL = r"""
WITH RECURSIVE counted AS (
  SELECT * FROM (SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents)
  WHERE n_tokens > 0),
sources AS (SELECT source, sum(n_tokens) AS tokens, count(*) AS n_docs FROM counted GROUP BY source),
shares AS (SELECT source, tokens, tokens / (SELECT sum(tokens) FROM sources) AS share FROM sources),
meets AS (
  SELECT step, max(power / tokens) / sum(power) * (SELECT sum(tokens) FROM sources) <= 1.25 AS ok
  FROM (SELECT step, tokens, pow(share, step / 4096.0) AS power
        FROM shares, (SELECT unnest(range(0, 4097)) AS step)) GROUP BY step),
chosen AS (SELECT min(step) / 4096.0 AS exponent FROM meets WHERE ok),
powers AS (SELECT source, tokens, pow(share, exponent) AS power FROM shares, chosen),
wanted AS (
  SELECT source, tokens, power / (SELECT sum(power) FROM powers) AS w,
    CAST(floor(power / (SELECT sum(power) FROM powers) * (SELECT sum(tokens) FROM sources) + 0.5)
      AS BIGINT) AS quota FROM powers),
plan AS (
  SELECT source, round(w, 9) AS weight, CAST(quota // tokens AS BIGINT) AS blocks,
    CAST(quota % tokens AS BIGINT) AS rest FROM wanted),
spread AS (
  SELECT doc_id, source, n_tokens, weight, rest, blocks, unnest(range(0, blocks + 1)) AS block
  FROM counted JOIN plan USING (source)),
keyed AS (
  SELECT *, ('0x' || substr(md5('0/' || block || '/' || doc_id), 1, 15))::BIGINT AS order_key
  FROM spread),
summed AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY source, block ORDER BY order_key, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM keyed)
SELECT doc_id, source, n_tokens, weight, block, order_key FROM summed
WHERE block < blocks OR before < rest
"""
