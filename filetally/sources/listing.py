"""Listings: landed pages of the file / folder / deleted union, batch and streaming.

Two layouts: ``pages`` (one row per page with its entries, as a listing call returns them)
and ``rows`` (one row per entry). In the ``rows`` layout root, depth and deletion filters
reach the Parquet scan; land large listings that way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filetally.errors import ConfigurationError
from filetally.functions.paths import validate_root
from filetally.guards import quote
from filetally.schemas import LISTING_PAGE, LISTING_ROW, complete

LAYOUTS = {"pages": LISTING_PAGE, "rows": LISTING_ROW}


def _schema(layout: str):
    if layout not in LAYOUTS:
        raise ConfigurationError("layout must be pages or rows.")
    return LAYOUTS[layout]


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row per entry, numbered through the whole listing."""
    return pages.selectExpr(
        "page", "first_ordinal", "posexplode(entries) AS (position, entry)"
    ).selectExpr("page", "first_ordinal + position AS ordinal", "entry.*")


def scope_listing(
    listing: DataFrame, root: str = "", recursive: bool = True, include_deleted: bool = True
) -> DataFrame:
    """Keep what a listing call for ``root`` would return.

    With an empty root a recursive listing keeps every entry, whatever its path. The root
    is a prefix test on the stored lower-case path, which the scan can use; depth is a
    second test on the remainder.
    """
    base = validate_root(root.rstrip("/")).lower()
    if base or not recursive:
        listing = listing.where(f"startswith(path_lower, {quote(base + '/')})")
    if not recursive:
        listing = listing.where(f"NOT contains(substring(path_lower, {len(base) + 2}), '/')")
    if not include_deleted:
        listing = listing.where("entry_type <> 'deleted'")
    return listing


def read_listing(
    spark: SparkSession,
    path: str,
    root: str = "",
    recursive: bool = True,
    include_deleted: bool = True,
    layout: str = "rows",
    file_format: str = "parquet",
) -> DataFrame:
    landed = spark.read.schema(_schema(layout)).format(file_format).load(path)
    rows = flatten_pages(landed) if layout == "pages" else landed
    return scope_listing(rows, root, recursive, include_deleted)


def stream_listing(
    spark: SparkSession,
    path: str,
    root: str = "",
    recursive: bool = True,
    include_deleted: bool = True,
    layout: str = "pages",
    file_format: str = "parquet",
    files_per_trigger: int | None = 1,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The same rows as a stream of landed files; the query's checkpoint is the cursor.

    One file per trigger makes a micro-batch one landed page file; None takes all there are.
    """
    landed = _landed_stream(spark, path, layout, file_format, files_per_trigger, options)
    rows = flatten_pages(landed) if layout == "pages" else landed
    return scope_listing(rows, root, recursive, include_deleted)


def stream_pages(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    files_per_trigger: int | None = 1,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Landed pages as they are, with their cursor and whether more follow."""
    return _landed_stream(spark, path, "pages", file_format, files_per_trigger, options)


def _landed_stream(spark, path, layout, file_format, files_per_trigger, options) -> DataFrame:
    reader = spark.readStream.schema(_schema(layout)).format(file_format).options(**(options or {}))
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def as_listing_rows(df: DataFrame) -> DataFrame:
    """Complete a narrower relation to the ``rows`` layout with null columns."""
    return complete(df, LISTING_ROW)


def land_listing(
    rows: DataFrame, path: str, page_size: int = 2000, has_more: str = "CAST(NULL AS BOOLEAN)"
) -> None:
    """Write listing rows as page rows of at most ``page_size`` entries.

    Pages are cut by ordinal, so a page is a bounded group by construction. ``has_more`` is an
    expression of ``page``; without one, pages do not say whether more follow. Pages already
    landed in ``path`` stay.
    """
    names = [c for c in LISTING_ROW.names if c not in ("page", "ordinal")]
    numbered = f"array_sort(collect_list(struct(ordinal, struct({', '.join(names)}) AS entry)))"
    pages = (
        rows.withColumn("page", F.expr(f"CAST(floor(ordinal / {page_size}) AS BIGINT)"))
        .groupBy("page")
        .agg(F.expr("min(ordinal) AS first_ordinal"), F.expr(f"{numbered} AS numbered"))
    )
    pages.selectExpr(
        "page",
        "first_ordinal",
        "concat('page-', page) AS cursor",
        f"{has_more} AS has_more",
        "numbered.entry AS entries",
    ).write.mode("append").parquet(path)
