"""Keyed building blocks: strict and replay dedup, unique keys, two-sided pairing.

Dedup is one partially aggregated ``groupBy``: copies of a hot key collapse on the map side,
so a key that holds a third of all rows reaches its reducer as one row per map task. As the
buffers are structs, Spark sorts before each half of the aggregate. Pairing expects unique
keys, where a map-side half would sort and reduce nothing, so it is dealt out first and sorted
once. No window is used, since a window would gather the whole group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.guards import quote, require


def _names(columns) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def _row(df: DataFrame, key: Sequence[str]) -> str:
    """SQL struct of the columns beside the key."""
    return f"struct({_names(c for c in df.columns if c not in key)})"


def dedupe_strict(
    df: DataFrame, key: Sequence[str], message: str = "'conflicting duplicate records'"
) -> DataFrame:
    """Drop identical duplicates of a key; fail if two rows of a key differ anywhere.

    Comparing the smallest and the largest row of a key is an exact, null-safe test that
    needs a single shuffle. ``message`` is SQL and may use the key columns.
    """
    row = _row(df, key)
    grouped = df.groupBy(*key).agg(F.expr(f"min({row}) AS low"), F.expr(f"max({row}) AS high"))
    checked = require(grouped, "low <=> high", message)
    return checked.select(*key, "low.*").select(*df.columns)


def dedupe_replay(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by ``order``: what repeated pages after a cursor reset converge to."""
    last = f"max_by(struct({_names(df.columns)}), struct({_names(order)})) AS last"
    return df.groupBy(*key).agg(F.expr(last)).select("last.*")


def assert_unique(df: DataFrame, key: Sequence[str], message: str) -> DataFrame:
    """All rows of ``df``, or a failing job if a key occurs twice, even identically."""
    grouped = df.groupBy(*key).agg(
        F.expr("count(1) AS copies"), F.expr(f"any_value({_row(df, key)}) AS row")
    )
    return require(grouped, "copies = 1", message).select(*key, "row.*").select(*df.columns)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.expr("count(1) AS copies")).where("copies > 1")


def pair_by_key(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Full outer pairing of two keyed relations: ``key, left, right, left_rows, right_rows``.

    Union plus one aggregate instead of a full outer join: one exchange carries both sides
    and the copies per side come for free, so a duplicate-key check needs no pass of its own.
    Rows are dealt out by key first; both halves of the aggregate then use the same sort.
    Sides without a row for the key are null structs.
    """
    a = left.selectExpr(*key, f"{_row(left, key)} AS left")
    b = right.selectExpr(*key, f"{_row(right, key)} AS right")
    both = a.unionByName(b, allowMissingColumns=True)
    return both.repartition(*key).groupBy(*key).agg(
        F.expr("any_value(left, true) AS left"),
        F.expr("any_value(right, true) AS right"),
        F.expr("count(left) AS left_rows"),
        F.expr("count(right) AS right_rows"),
    )


def unique_sides(paired: DataFrame, message: str) -> DataFrame:
    """A pairing whose sides have at most one row per key, or a failing job."""
    return require(paired, "left_rows <= 1 AND right_rows <= 1", message)


def named(text: str, *columns: str) -> str:
    """SQL message of a fixed text followed by column values."""
    return f"concat({', '.join([quote(text), *columns])})"
