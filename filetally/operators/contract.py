"""Data-contract checks: declared schema and value rules of streams and state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from filetally.errors import ConfigurationError
from filetally.functions.paths import is_safe_relative
from filetally.guards import non_empty, quoted
from filetally.operators.keyed import duplicate_keys
from filetally.schemas import CONTRACTS, EXTRACTION_STATE, TRANSFER_STATE

COUNTS = "rule string, column string, violations long"


def _shape(kind: T.DataType) -> object:
    """Type without nullability, so that only names and types are compared."""
    if isinstance(kind, T.StructType):
        return {f.name: _shape(f.dataType) for f in kind.fields}
    if isinstance(kind, T.ArrayType):
        return [_shape(kind.elementType)]
    return kind.simpleString()


def structure_violations(df: DataFrame, schema: T.StructType, extra: bool) -> list[tuple]:
    """Missing, unexpected and wrongly typed columns; a driver-side look at two schemas."""
    actual = {f.name: _shape(f.dataType) for f in df.schema.fields}
    expected = {f.name: _shape(f.dataType) for f in schema.fields}
    found = [("missing_column", c, 1) for c in expected if c not in actual]
    if not extra:
        found += [("extra_column", c, 1) for c in actual if c not in expected]
    found += [
        ("wrong_type", c, 1) for c in expected if c in actual and actual[c] != expected[c]
    ]
    return found


def _counted(df: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """All rules in a single global aggregate, returned as one row per rule."""
    one = df.selectExpr(*[f"count_if({bad}) AS r{i}" for i, (_, _, bad) in enumerate(rules)])
    rows = ", ".join(
        f"struct('{rule}' AS rule, '{column}' AS column, r{i} AS violations)"
        for i, (rule, column, _) in enumerate(rules)
    )
    return one.selectExpr(f"inline(array({rows}))")


def _with_structure(counted: DataFrame, broken: list[tuple]) -> DataFrame:
    if not broken:
        return counted
    return counted.unionByName(counted.sparkSession.createDataFrame(broken, COUNTS))


def check_contract(df: DataFrame, stream: str) -> DataFrame:
    """``rule, column, violations`` for every rule of a stream; all zero means it holds."""
    if stream not in CONTRACTS:
        raise ConfigurationError(f"unknown stream {stream}.")
    contract = CONTRACTS[stream]
    broken = structure_violations(df, contract.schema, contract.extra_columns)
    unusable = {column for kind, column, _ in broken if kind != "extra_column"}
    rules = [("required", c, f"{c} IS NULL") for c in contract.required]
    rules += [
        ("allowed_values", c, f"{c} NOT IN ({quoted(allowed)})")
        for c, allowed in contract.values.items()
    ]
    usable = [rule for rule in rules if rule[1].split(".")[0] not in unusable]
    return _with_structure(_counted(df, usable), broken)


def check_state(df: DataFrame, kind: str = "transfer") -> DataFrame:
    """The same for a state table; extraction state may have a null path."""
    if kind not in ("transfer", "extraction"):
        raise ConfigurationError("kind must be transfer or extraction.")
    schema = TRANSFER_STATE if kind == "transfer" else EXTRACTION_STATE
    broken = structure_violations(df, schema, extra=False)
    required = ["file_id", "rev", "content_hash"] + (["path"] if kind == "transfer" else [])
    rules = [("non_empty", c, f"NOT {non_empty(c)}") for c in required if c in df.columns]
    if kind == "transfer" and "path" in df.columns:
        rules.append(("safe_path", "path", f"NOT {is_safe_relative('path')}"))
    counted = _counted(df, rules)
    if "file_id" in df.columns:
        repeated = duplicate_keys(df, ["file_id"]).selectExpr(
            "'unique' AS rule", "'file_id' AS column", "count(1) AS violations"
        )
        counted = counted.unionByName(repeated)
    return _with_structure(counted, broken)
