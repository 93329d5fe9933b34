"""Staged files as rows, digests of files of any size, and rows staged as files.

A listing of staged files reads no byte. Their content can come along as rows, as far as a row
can hold it; digests do without: each named file is read in pieces by the task it fell to.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filetally.guards import quote
from filetally.session import materialize

# Fixed value: a binary value in a row holds so many bytes at most.
LARGEST_VALUE = 2**31 - 1
PIECE = 8 * 1024 * 1024  # bytes of a file in memory at once
LISTED = 10_000  # names in memory at once
FOLDERS = 256  # that staged rows are dealt to


def read_staged(
    spark: SparkSession, path: str, pattern: str | None = None, content: bool = True
) -> DataFrame:
    """``path`` (plain, without scheme), ``length`` and ``content`` of every staged file.

    A file that no row can hold keeps its row with a null content: it is present, and a check
    of its digest reports that it could not be read. Without ``content`` only names and lengths
    are listed, and a check reads the files it needs whatever their size. On a folder that all
    executors mount the tasks list it, so that no name passes the driver; elsewhere Spark does.
    """
    if not content and _mounted(path):
        return _listed(spark, path, pattern)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path)
    plain = "regexp_replace(path, '^file:/+', '/') AS path"
    if not content:
        return files.selectExpr(plain, "length")
    whole = files.where(f"length <= {LARGEST_VALUE}").selectExpr(plain, "length", "content")
    large = files.where(f"length > {LARGEST_VALUE}").selectExpr(
        plain, "length", "CAST(NULL AS BINARY) AS content"
    )
    return whole.unionByName(large)


def _mounted(path: str) -> bool:
    """Is it the path of a folder on a mounted file system, without wildcards?"""
    return re.match(r"(file:|(?![^/]*:))[^*?\[{]*$", path) is not None


def _local(path: str) -> str:
    return re.sub("^file:/+", "/", path)


def _glob(pattern: str) -> str:
    """A regular expression for Spark's glob of a file name, as ``pathGlobFilter`` takes it."""
    parts, depth = [], 0
    for token in re.findall(r"\\.|\[[!^]?\]?[^\]]*\]|.", pattern, re.DOTALL):
        if token in ("*", "?"):
            parts.append("[^/]*" if token == "*" else "[^/]")
        elif token == "{" or (depth and token in ",}"):
            depth += {"{": 1, "}": -1}.get(token, 0)
            parts.append({"{": "(?:", ",": "|", "}": ")"}[token])
        elif len(token) > 2:
            negated = token[1] in "!^"
            inside = re.sub(r"([\[&\\])", r"\\\1", token[2 if negated else 1:-1])
            parts.append(f"[{'^' if negated else ''}{inside}]")
        else:
            parts.append("\\" + token[-1] if re.match(r"[^A-Za-z0-9_\s]", token[-1]) else token[-1])
    return f"(?s)\\A{''.join(parts)}\\z"


def _listed(spark: SparkSession, path: str, pattern: str | None) -> DataFrame:
    """``path`` and ``length`` of all files below a mounted folder, by the tasks.

    One job for each level of folders; those of a level are spread over the tasks. Names that
    Spark's own readers leave out are left out.
    """

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(folders):
            for folder in folders:
                if os.path.isfile(folder):
                    yield folder, os.path.getsize(folder), False
                    continue
                with os.scandir(folder) as found:
                    for e in found:
                        hidden = e.name.startswith("_") and "=" not in e.name
                        if hidden or e.name.startswith(".") or e.name.endswith("._COPYING_"):
                            continue
                        nested = e.is_dir()
                        yield f"{folder}/{e.name}", 0 if nested else e.stat().st_size, nested

        def batch(made):
            return pa.RecordBatch.from_pylist(
                [dict(zip(schema.names, r)) for r in made], schema
            )

        schema = pa.schema(
            [("path", pa.string()), ("length", pa.int64()), ("folder", pa.bool_())]
        )
        for given in batches:
            made = []
            for row in rows(given.column(0).to_pylist()):
                made.append(row)
                if len(made) == LISTED:
                    yield batch(made)
                    made = []
            yield batch(made)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    level, files = spark.createDataFrame([(_local(path).rstrip("/") or "/",)], "path string"), None
    while True:
        found = materialize(
            level.mapInArrow(entries, "path string, length long, folder boolean"), "staged-level"
        )
        here = found.where("NOT folder").select("path", "length")
        files = here if files is None else files.unionByName(here)
        level = found.where("folder").select("path")
        if level.isEmpty():
            break
        # With a number: folders are few bytes, which would be coalesced to one task.
        level = level.repartition(tasks, "path")
    if pattern:
        files = files.where(f"substring_index(path, '/', -1) RLIKE {quote(_glob(pattern))}")
    return files


def write_staged(rows: DataFrame, folder: str) -> int:
    """Stage each row as a file: its ``content`` under its ``name``; returns their number.

    ``folder`` is one that all executors mount. The tasks write the files themselves, into a fixed
    number of folders by a hash of the name, and nothing is left to be moved when they are done. A
    file appears under its name when it is whole, so repeating a task writes the same again.
    """
    root = _local(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dealt, names, contents = (batch.column(c) for c in ("dealt", "name", "content"))
            for number, name, content in zip(dealt.to_pylist(), names.to_pylist(), contents):
                inside = f"{root}/folder={number}"
                hidden = f"{inside}/.{name}.{os.getpid()}"
                os.makedirs(inside, exist_ok=True)
                with open(hidden, "wb") as file:
                    file.write(content.as_buffer() or b"")
                os.replace(hidden, f"{inside}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([len(names)], pa.int64())], ["files"])

    dealt = rows.select(
        F.expr(f"pmod(xxhash64(name), {FOLDERS})").alias("dealt"), "name", "content"
    )
    return dealt.mapInArrow(write, "files long").agg(F.sum("files")).first()[0] or 0


def file_digests(files: DataFrame, piece: int = PIECE) -> DataFrame:
    """``path`` and SHA-256 ``digest`` of each file that ``files`` names in ``path``.

    A file is one sequential read of ``piece`` bytes at a time, so none is ever a row and memory
    does not grow with it. A path without scheme is a local one, on a folder that all executors
    mount; others are opened by Arrow's file systems. A file that cannot be read has a null
    digest. Files are spread by path, as many at once as there are tasks.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Imported here: a task needs Arrow, but not this library.
        from pyarrow import fs

        local = fs.LocalFileSystem()
        for batch in batches:
            paths, digests = batch.column(0).to_pylist(), []
            for path in paths:
                state = hashlib.sha256()
                try:
                    system, inner = (
                        fs.FileSystem.from_uri(path) if "://" in path else (local, path)
                    )
                    with system.open_input_stream(inner, buffer_size=0) as stream:
                        while part := stream.read(piece):
                            state.update(part)
                    digests.append(state.hexdigest())
                except (OSError, pa.ArrowInvalid):
                    digests.append(None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(digests, pa.string())], ["path", "digest"]
            )

    # By a number and a hash: paths are few bytes, which would be coalesced to few tasks, and an
    # exchange by the path itself would be left out after the one of ``distinct``.
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = files.select("path").distinct().repartition(tasks, F.xxhash64("path"))
    return spread.mapInArrow(read, "path string, digest string")
