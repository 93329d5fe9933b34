"""Column builders over the benchmark tables."""

from pyspark.sql import functions as F

from filetally import functions as fn
from filetally.catalog.registry import query
from filetally.fixtures import HAS_OFFSET, INSTANT, fixture, table
from filetally.functions.times import format_utc, last_modified
from filetally.operators.versions import MARKDOWN_SUFFIXES, with_transferable


@query(
    """SELECT url,
      coalesce(path_display = '/Web' OR starts_with(lower(path_display), '/web/'), false) AS in_web,
      path_display IS NOT NULL AS in_any FROM fx_links""",
    uses="fx_links",
)
def path_scope(spark, sf):
    path = "lower(path_display)"
    return fixture(spark, sf, "fx_links").select(
        "url", fn.in_scope(path, "/WEB/").alias("in_web"), fn.in_scope(path, "").alias("in_any")
    )


@query(
    """SELECT file_id, CASE WHEN starts_with(path_display, '/Source-Root/')
        THEN lower(substr(path_display, 14)) END AS normalized,
      CASE WHEN starts_with(path_display, '/Source-Root/') THEN substr(path_display, 14) END
        AS display FROM fx_source""",
    uses="fx_source",
)
def relative_paths(spark, sf):
    path = fn.relative_path("lower(path_display)", "path_display", "/source-ROOT")
    return fixture(spark, sf, "fx_source").select(
        "file_id", path.normalized.alias("normalized"), path.display.alias("display")
    )


@query(
    """SELECT idx, path, NOT (path = '' OR starts_with(path, '/') OR contains(path, '//')
      OR list_has_any(string_split(path, '/'), ['', '.', '..'])) AS safe FROM fx_records""",
    uses="fx_records",
)
def safe_paths(spark, sf):
    return fixture(spark, sf, "fx_records").select(
        "idx", "path", fn.is_safe_relative("path").alias("safe")
    )


@query(
    """SELECT file_id, path FROM fx_version_state WHERE ends_with(path, '.PDF')
      OR starts_with(path, 'old/') OR regexp_full_match(path, '[A-Z]+/[^/]*/Doc-[^/]2[.]txt')""",
    uses="fx_version_state",
)
def glob_filter(spark, sf):
    globs = ["**/*.PDF", "old/**", "[A-Z][A-Z]/*/Doc-?2.txt"]
    return (
        fixture(spark, sf, "fx_version_state")
        .where(fn.matches_globs("path", globs))
        .select("file_id", "path")
    )


@query(
    """SELECT file_id, lower(regexp_extract(name, '([.][^.]+)$', 1)) AS extension,
      lower(regexp_extract(name, '([.][^.]+)$', 1)) IN ('.binder', '.docx', '.gsheet', '.html',
        '.ods', '.paper', '.papert', '.pdf', '.pptx', '.xlsx') AS convertible FROM fx_source""",
    uses="fx_source",
)
def file_extensions(spark, sf):
    suffix = fn.extension("name")
    return fixture(spark, sf, "fx_source").select(
        "file_id",
        suffix.alias("extension"),
        suffix.isin(*MARKDOWN_SUFFIXES).alias("convertible"),
    )


@query(
    """SELECT file_id, size * 1000 AS size, size * 1000 <= 2097152 AS transferable
      FROM fx_source""",
    uses="fx_source",
)
def size_cap(spark, sf):
    files = fixture(spark, sf, "fx_source").withColumn("size", F.col("size") * 1000)
    return with_transferable(files, 2).select("file_id", "size", "transferable")


_AT = INSTANT.format("modified_at")


@query(
    f"""SELECT idx, modified_at AS kept, CASE WHEN {HAS_OFFSET.format('modified_at')}
        THEN strftime({_AT}, '%Y-%m-%dT%H:%M:%SZ') END AS aware_only,
      strftime({_AT}, '%Y-%m-%dT%H:%M:%SZ') AS assumed
      FROM fx_records""",
    uses="fx_records",
)
def utc_times(spark, sf):
    raw = "modified_at"
    return fixture(spark, sf, "fx_records").select(
        "idx",
        fn.to_utc(raw, "keep").alias("kept"),
        fn.to_utc(raw, "null").alias("aware_only"),
        fn.to_utc(raw, "assume_utc").alias("assumed"),
    )


@query(
    """SELECT file_id, concat('file:', file_id) AS entry_key,
      file_id || ':' || rev || ':' || content_hash AS version_key,
      file_id || '|' || rev || '|' || content_hash AS property_key FROM fx_destination""",
    uses="fx_destination",
)
def surrogate_keys(spark, sf):
    parts = "file_id", "rev", "content_hash"
    return fixture(spark, sf, "fx_destination").select(
        "file_id",
        fn.entry_key("'file'", "file_id").alias("entry_key"),
        fn.version_key(*parts).alias("version_key"),
        fn.property_key(*parts).alias("property_key"),
    )


@query(
    f"""SELECT s.file_id, strftime(coalesce(
        CASE WHEN {HAS_OFFSET.format('r.modified_at')} THEN {INSTANT.format('r.modified_at')} END,
        TRY_CAST(s.client_modified AS TIMESTAMP), TIMESTAMP '1970-01-01'),
        '%Y-%m-%dT%H:%M:%SZ') AS last_modified
      FROM fx_source s JOIN fx_records r ON r.idx = s.ordinal""",
    uses="fx_source fx_records",
)
def last_modified_times(spark, sf):
    records = fixture(spark, sf, "fx_records").select(
        F.col("idx").alias("ordinal"), F.col("modified_at").alias("server_modified")
    )
    files = fixture(spark, sf, "fx_source").join(records, "ordinal")
    instant = format_utc(last_modified("server_modified", "client_modified"))
    return files.selectExpr("file_id", f"{instant} AS last_modified")


@query(
    """SELECT file_id, CASE lower(regexp_extract(name, '([.][^.]+)$', 1))
        WHEN '.pdf' THEN 'application/pdf' WHEN '.html' THEN 'text/html'
        WHEN '.txt' THEN 'text/plain' END AS media_type
      FROM fx_source""",
    uses="fx_source",
)
def media_types(spark, sf):
    files = fixture(spark, sf, "fx_source")
    return fn.with_media_type(files).select("file_id", "media_type")


@query(
    """SELECT concat('/Exports/', path) AS target, concat('/Exports/',
        split_part(path, '/', 1)) AS first_folder, len(string_split(path, '/')) - 1 AS depth
      FROM fx_version_state""",
    uses="fx_version_state",
)
def target_paths(spark, sf):
    target = fn.target_path("/Exports", "path")
    folders = fn.ancestors("concat('/Exports/', path)", "/Exports")
    return fixture(spark, sf, "fx_version_state").select(
        target.alias("target"),
        F.get(folders, F.lit(0)).alias("first_folder"),
        F.size(folders).cast("long").alias("depth"),
    )


@query(
    """SELECT doc_id, md5(replace(replace(lower(text), 'ß', 'ss'), 'ς', 'σ')) AS folded_md5
      FROM documents"""
)
def folded_text(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(fn.fold("text")).alias("folded_md5")
    )


@query(
    """SELECT file_id, CASE WHEN starts_with(path_display, '/Source-Root/')
        THEN substr(path_display, 14) ELSE ltrim(path_display, '/') END AS transfer_path
      FROM fx_source""",
    uses="fx_source",
)
def transfer_paths(spark, sf):
    path = fn.transfer_path("path_display", "name", "/source-root/")
    return fixture(spark, sf, "fx_source").select("file_id", path.alias("transfer_path"))
