"""Fail-closed checks that stay inside the plan, where they were written.

A check in a projected column disappears when the column is pruned, so every guard is a
filter whose condition raises. As a deterministic filter it would still wander: pushed below
a join, or inferred for the other side of one, it fails on rows that were never to be tested;
and a filter added later, pushed below it, would hide rows from it. Asking for the partition
number in the failing branch makes the condition non-deterministic, which pins it in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from filetally.errors import ContractError


def quote(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(values) -> str:
    """SQL list of string literals."""
    return ", ".join(quote(v) for v in values)


# False on every row, but not to the optimizer: a literal would let it drop the branch that
# depends on it and, with the whole result known to be empty, the checks below it.
NEVER = "(spark_partition_id() < 0)"


def fails(message: str) -> str:
    """Boolean SQL that raises ``message``, which is SQL too and can name the row's key."""
    return f"({NEVER} OR CAST(raise_error({message}) AS BOOLEAN))"


def passes(condition: str, message: str) -> str:
    """SQL that is true where ``condition`` holds and raises where it is false or null."""
    return f"CASE WHEN coalesce({condition}, false) THEN true ELSE {fails(message)} END"


def require(df: DataFrame, condition: str, message: str) -> DataFrame:
    """All rows of ``df``, or a failing job if one of them breaks ``condition``."""
    return df.where(passes(condition, message))


def require_empty(violations: DataFrame, message: str) -> None:
    """Run a violations query and raise if it yields a row; only one row reaches the driver."""
    if not violations.isEmpty():
        raise ContractError(message)


def non_empty(*columns: str) -> str:
    """Every one of ``columns`` holds a non-empty string."""
    return "(" + " AND ".join(f"coalesce({c} <> '', false)" for c in columns) + ")"
