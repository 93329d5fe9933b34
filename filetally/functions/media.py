"""Media type of a file name through a small broadcast table."""

from __future__ import annotations

import mimetypes
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.guards import quote

# Suffixes that stand for two, and suffixes that only name an encoding.
SHORT_SUFFIXES = {
    ".svgz": ".svg.gz",
    ".tgz": ".tar.gz",
    ".taz": ".tar.gz",
    ".tz": ".tar.gz",
    ".tbz2": ".tar.bz2",
    ".txz": ".tar.xz",
}
ENCODINGS = r"\.(gz|Z|bz2|xz|br)\z"


@lru_cache(maxsize=1)
def _known_types() -> list[tuple[str, str]]:
    """Suffix and type pairs of the standard library's own table, without system files."""
    return sorted(mimetypes.MimeTypes(filenames=()).types_map[True].items())


def media_suffix(name: str) -> str:
    """SQL for the suffix that decides the type: short forms spelled out, encoding removed."""
    base = f"element_at(split({name}, '/'), -1)"
    for short, full in SHORT_SUFFIXES.items():
        base = f"regexp_replace({base}, {quote(rf'(?i)(?<=.)\{short}\z')}, {quote(full)})"
    base = f"regexp_replace({base}, {quote(rf'(?<=.){ENCODINGS}')}, '')"
    return f"lower(regexp_extract({base}, {quote(r'(?s)^\.*[^.].*(\.[^.]*)\z')}, 1))"


def with_media_type(df: DataFrame, name: str = "name", into: str = "media_type") -> DataFrame:
    """Add ``into``; unknown suffixes give null. The table has a fixed size, so it is broadcast."""
    types = df.sparkSession.createDataFrame(_known_types(), f"_suffix string, {into} string")
    return (
        df.withColumn("_suffix", F.expr(media_suffix(name)))
        .join(F.broadcast(types), "_suffix", "left")
        .drop("_suffix")
    )
