"""Version state: a keyed Parquet table plus one-row headers that commit its versions.

A version is either complete or holds only the rows that changed since the one before, so
a small batch writes little however large the state is; every so many versions a complete
one starts over. The header is written last, so a reader never sees a half-written version,
and repeating the write of a version changes nothing. Headers are one row per version and
bounded; file rows stay distributed.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filetally.errors import ContractError
from filetally.functions.paths import is_safe_relative
from filetally.guards import non_empty, passes
from filetally.operators.keyed import dedupe_replay
from filetally.schemas import BOOLEAN, EXTRACTION_STATE, LONG, STRING, TRANSFER_STATE, struct
from filetally.sources.written import read_written

# Current layout versions of the two kinds of state.
TRANSFER_VERSION = 3
EXTRACTION_VERSION = 1

HEADER = struct(
    version=LONG,
    base=LONG,
    layout=T.IntegerType(),
    scope_path=STRING,
    recursive=BOOLEAN,
    cursor=STRING,
)
# Changed-rows versions a reader has to lay over a complete one, at most.
COMPACT_EVERY = 20


@dataclass(frozen=True)
class Scope:
    """What a listing covered; compared without a trailing slash."""

    path: str
    recursive: bool = True

    def __post_init__(self) -> None:
        object.__setattr__(self, "path", self.path.rstrip("/"))


@dataclass(frozen=True)
class State:
    """File versions and the header that says how far and over what they were taken."""

    files: DataFrame
    scope: Scope | None = None
    cursor: str | None = None
    layout: int = TRANSFER_VERSION
    version: int | None = None
    base: int | None = None

    @property
    def legacy(self) -> bool:
        """Layout 1 knew no scope."""
        return self.layout == 1

    @property
    def can_resume(self) -> bool:
        """A stored cursor allows a delta; anything else needs a snapshot."""
        return self.cursor is not None and not self.legacy

    def advanced(
        self, files: DataFrame, cursor: str | None, scope: Scope, errors: int = 0
    ) -> State:
        """Next state; the cursor moves only when not a single row failed."""
        if errors or cursor is None:
            cursor = self.cursor
        elif not cursor:
            raise ContractError("cursor must be a non-empty string.")
        return replace(self, files=files, cursor=cursor, scope=scope, layout=TRANSFER_VERSION)


def empty_state(spark: SparkSession, schema: T.StructType = TRANSFER_STATE) -> State:
    return State(spark.createDataFrame([], schema))


def _state_rule(kind: str) -> str:
    """Filter that fails the job on a row a state table must not hold."""
    rule = non_empty("file_id", "rev", "content_hash")
    if kind == "transfer":
        rule = f"{rule} AND {is_safe_relative('path')}"
    return passes(rule, f"'{kind} state has an invalid row.'")


def _schema(kind: str) -> T.StructType:
    return TRANSFER_STATE if kind == "transfer" else EXTRACTION_STATE


def write_state(
    state: State,
    path: str,
    version: int,
    kind: str = "transfer",
    changes: DataFrame | None = None,
) -> None:
    """Write one version; the header row, written last, commits it.

    ``changes`` are the rows that differ from ``state.version`` (see ``state_changes``);
    with them only these are written, unless a complete version is due.
    """
    names = _schema(kind).names
    partial = changes is not None and state.base is not None
    partial = partial and version - state.base < COMPACT_EVERY
    if partial:
        rows = changes.where(f"removed OR {_state_rule(kind)}").select(*names, "removed")
    else:
        rows = state.files.where(_state_rule(kind)).selectExpr(*names, "false AS removed")
    rows.write.mode("overwrite").parquet(f"{path}/files/version={version}")
    write_header(state, path, version, kind, state.base if partial else version)


def write_header(
    state: State, path: str, version: int, kind: str = "transfer", base: int | None = None
) -> None:
    """The one row that commits a version: how far and over what it was taken."""
    spark = state.files.sparkSession
    scope = state.scope or Scope("", True)
    layout = TRANSFER_VERSION if kind == "transfer" else EXTRACTION_VERSION
    base = version if base is None else base
    header = [(version, base, layout, scope.path, scope.recursive, state.cursor)]
    spark.createDataFrame(header, HEADER).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/headers/of={version}"
    )


def read_state(
    spark: SparkSession, path: str, kind: str = "transfer", before: int | None = None
) -> State:
    """Newest committed version, or the newest below ``before``; empty state if none."""
    schema = _schema(kind)
    headers, newest = _headers(spark, path, kind, before)
    if newest is None:
        return empty_state(spark, schema)
    laid_over = headers.where(
        (F.col("version") > newest.base) & (F.col("version") <= newest.version)
    )
    # A complete version ends every range of partial ones, so the range is short.
    partials = [row.version for row in laid_over.select("version").collect()]
    stored = T.StructType([*schema.fields, T.StructField("removed", T.BooleanType())])
    reader = spark.read.schema(stored).option("basePath", f"{path}/files")
    files = reader.parquet(f"{path}/files/version={newest.base}").select(*schema.names)
    if partials:
        changed = reader.parquet(*[f"{path}/files/version={v}" for v in sorted(partials)])
        latest = dedupe_replay(changed, ["file_id"], ["version"])
        # What changed is small next to the base: the anti join is left to its measured size.
        files = files.join(latest.select("file_id"), "file_id", "left_anti").unionByName(
            latest.where("NOT removed").select(*schema.names)
        )
    return State(
        files, Scope(newest.scope_path, newest.recursive), newest.cursor, newest.layout,
        newest.version, newest.base,
    )


def read_header(spark: SparkSession, path: str, files: DataFrame, before: int | None = None) -> State:
    """The newest committed version with rows that are kept elsewhere."""
    newest = _headers(spark, path, "transfer", before)[1]
    if newest is None:
        return State(files)
    scope = Scope(newest.scope_path, newest.recursive)
    return State(files, scope, newest.cursor, newest.layout, newest.version, newest.base)


def _headers(spark: SparkSession, path: str, kind: str, before: int | None):
    """All headers below ``before`` and the newest of them, None if there is none."""
    headers = read_written(spark, f"{path}/headers", HEADER)
    if before is not None:
        headers = headers.where(F.col("version") < before)
    newest = headers.orderBy(F.desc("version")).first()
    supported = (1, 2, TRANSFER_VERSION) if kind == "transfer" else (EXTRACTION_VERSION,)
    if newest is not None and newest.layout not in supported:
        raise ContractError("No reader for the layout of this state.")
    return headers, newest


def read_state_json(spark: SparkSession, path: str, kind: str = "transfer") -> State:
    """Load state stored as one JSON document with a map of files.

    The document is one row by nature; its map is exploded and spread out at once.
    """
    entry = "struct<path:string, rev:string, content_hash:string>"
    document = (
        f"version int, scope struct<path:string, recursive:boolean>, cursor string, "
        f"files map<string, {entry}>, bad string"
    )
    parsed = (
        spark.read.schema(document)
        .option("multiLine", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "bad")
        .json(path)
    )
    header = parsed.select(
        "version", "scope", "cursor", F.col("bad").isNotNull().alias("bad"),
        F.col("files").isNull().alias("no_files"),
    ).first()
    supported = (1, 2, TRANSFER_VERSION) if kind == "transfer" else (EXTRACTION_VERSION,)
    if header is None or header.bad or header.no_files or header.version not in supported:
        raise ContractError(f"This is no {kind} state: version or files do not fit.")
    scope = None
    if kind == "transfer" and header.version > 1:
        if header.scope is None or header.scope.path is None or header.scope.recursive is None:
            raise ContractError("A transfer state from layout 2 on names its scope.")
        scope = Scope(header.scope.path, header.scope.recursive)
    if kind == "transfer" and header.version == TRANSFER_VERSION and not header.cursor:
        raise ContractError("A transfer state of the newest layout carries a cursor.")
    schema = _schema(kind)
    files = (
        parsed.select(F.explode("files").alias("file_id", "v"))
        .select("file_id", "v.path", "v.rev", "v.content_hash")
        .select(*schema.names)
        .repartition("file_id")
        .where(_state_rule(kind))
    )
    cursor = header.cursor if header.version == TRANSFER_VERSION else None
    return State(files, scope, cursor, header.version)
