"""Chat formatting: collapse cumulative snapshots, then render what is left.

A chat log often holds a conversation again after every turn, so earlier snapshots are
prefixes of the last one. Each turn is hashed with its position; the xor of these hashes up
to a turn identifies the prefix that ends there. A conversation is dropped if its whole equals
a proper prefix of another one (an anti join on length and hash), and of equal ones the
smallest id stays.

Prefix hashes and positions are summed within ranges of turn numbers and then over the ranges,
so one very long conversation is worked on in parts. For the same reason rendered text comes
in segments of at most ``segment`` turns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filetally.llm.common import materialize

RANGE = 256  # turn numbers in a range


def numbered(turns: DataFrame) -> DataFrame:
    """Distinct turns with their position and the hashes of the prefix they end."""
    clean = turns.select(
        "conv_id", F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"), "role", "text"
    ).where("conv_id IS NOT NULL").distinct()
    clean = clean.withColumn("range", F.floor(F.col("turn") / RANGE))
    sizes = clean.groupBy("conv_id", "range").agg(F.count("*").alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "conv_id", "range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset")
    )
    order = Window.partitionBy("conv_id", "range").orderBy("turn", "role", "text")
    placed = (
        clean.withColumn("place", F.row_number().over(order))
        .join(offsets, ["conv_id", "range"])
        .withColumn("place", F.col("place") + F.col("offset") - 1)
        .drop("offset")
    )
    fields = ["place", F.isnull("role"), F.coalesce("role", F.lit("")), F.isnull("text"), F.coalesce("text", F.lit(""))]
    hashed = materialize(
        placed.withColumn("low", F.xxhash64(*fields)).withColumn(
            "high", F.xxhash64(F.lit("second"), *fields)
        ),
        "chat-turns",
    )
    sums = hashed.groupBy("conv_id", "range").agg(
        F.bit_xor("low").alias("range_low"), F.bit_xor("high").alias("range_high")
    )
    before = sums.select(
        "conv_id",
        "range",
        F.coalesce(F.bit_xor("range_low").over(earlier), F.lit(0)).alias("range_low"),
        F.coalesce(F.bit_xor("range_high").over(earlier), F.lit(0)).alias("range_high"),
    )
    upto = (
        Window.partitionBy("conv_id", "range")
        .orderBy("place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        hashed.withColumn("low", F.bit_xor("low").over(upto))
        .withColumn("high", F.bit_xor("high").over(upto))
        .join(before, ["conv_id", "range"])
        .select(
            "conv_id",
            "place",
            "role",
            "text",
            F.col("low").bitwiseXOR(F.col("range_low")).alias("low"),
            F.col("high").bitwiseXOR(F.col("range_high")).alias("high"),
        )
    )


def maximal(turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, n_copies)`` of conversations that are no prefix of another one."""
    lengths = turns.groupBy("conv_id").agg(F.max("place").alias("place"))
    ends = turns.join(lengths, ["conv_id", "place"]).select("conv_id", "place", "low", "high")
    key = ["place", "low", "high"]
    inner = (
        turns.join(lengths.withColumnRenamed("place", "last"), "conv_id")
        .where("place < last")
        .select(*key)
        .distinct()
    )
    return (
        ends.groupBy(*key)
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
        .join(inner, key, "left_anti")
        .select("conv_id", (F.col("place") + 1).cast("long").alias("n_turns"), "n_copies")
    )


def render(turns: DataFrame, kept: DataFrame, segment: int) -> DataFrame:
    """Text of the kept conversations, in segments; marks inside a text are broken up."""
    safe = F.regexp_replace(F.coalesce("text", F.lit("")), r"<\|", "< |")
    role = F.regexp_replace(F.coalesce("role", F.lit("unknown")), r"[|<>\s]", "")
    line = F.concat(F.lit("<|"), role, F.lit("|>\n"), safe, F.lit("\n<|end|>\n"))
    parts = F.array_sort(F.collect_list(F.struct("place", line.alias("line"))))
    return (
        turns.join(kept, "conv_id")
        .withColumn("segment", F.floor(F.col("place") / segment))
        .groupBy("conv_id", "segment", "n_turns", "n_copies")
        .agg(parts.alias("parts"))
        .select(
            "conv_id",
            "segment",
            "n_turns",
            "n_copies",
            F.array_join(F.transform("parts", lambda p: p["line"]), "").alias("rendered"),
        )
    )


def format_chats(conversations: DataFrame, segment: int = 64) -> DataFrame:
    """Rendered maximal conversations of ``conversations`` (conv_id, turn, role, text).

    Columns: conv_id, segment, n_turns, n_copies (equal conversations), rendered. Turns go by
    number, then role and text; a null number comes first. Equal rows of one conversation count
    once. Rows without conv_id belong to no conversation and are left out. Null and empty texts
    are turns with an empty text, though they do not equal each other; a null role is
    ``unknown``. An empty table gives an empty result; other columns are ignored. Prefixes are
    told apart by 128-bit hashes.
    """
    turns = materialize(numbered(conversations), "chat-prefixes")
    kept = materialize(maximal(turns), "chat-kept")
    return render(turns, kept, segment)


SQL = r"""
WITH turns AS (
  SELECT conv_id, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS place
  FROM (SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, role, text FROM conversations)),
prefixes AS (
  SELECT conv_id, place, max(place) OVER (PARTITION BY conv_id) AS last,
    list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY place
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p
  FROM turns),
kept AS (
  SELECT min(conv_id) AS conv_id, count(*) AS n_copies, any_value(last) + 1 AS n_turns
  FROM prefixes WHERE place = last AND p NOT IN (SELECT p FROM prefixes WHERE place < last)
  GROUP BY p)
SELECT conv_id, place // 64 AS segment, n_turns, n_copies,
  string_agg('<|' || role || '|>' || chr(10) || replace(text, '<|', '< |') || chr(10) || '<|end|>'
    || chr(10), '' ORDER BY place) AS rendered
FROM turns JOIN kept USING (conv_id) GROUP BY 1, 2, 3, 4
"""
