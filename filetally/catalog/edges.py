"""Cases at the edges of operators: sizes at a cap, odd names and times, what is left out."""

from pyspark.sql import functions as F

from filetally import functions as fn
from filetally.catalog.inventory import (
    _ACL,
    _LINKS,
    _PROPERTIES,
    _acl,
    _landed_folders,
    _landed_links,
    _properties,
)
from filetally.catalog.migration import _CONTENTS, EXTRACTED, SUFFIXES, _contents
from filetally.catalog.registry import change_listing, file_listing, query
from filetally.fixtures import fixture, table
from filetally.operators import relations
from filetally.operators.contract import check_contract, check_state
from filetally.operators.records import validate_records
from filetally.operators.versions import skipped_documents
from filetally.plans.migration import skipped_files
from filetally.session import materialize


@query(
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN concat('.pdf', chr(10))
        WHEN 1 THEN concat('.b', chr(10), 'c') WHEN 2 THEN '' ELSE '.tar' END AS extension
      FROM documents"""
)
def newline_extensions(spark, sf):
    """A line break is part of a suffix like any other character, also at the end."""
    n = F.col("doc_id").cast("string")
    name = (
        F.when(F.col("doc_id") % 4 == 0, F.concat(n, F.lit(".PDF\n")))
        .when(F.col("doc_id") % 4 == 1, F.concat(n, F.lit(".a.B\nc")))
        .when(F.col("doc_id") % 4 == 2, F.concat(n, F.lit("\n")))
        .otherwise(F.concat(n, F.lit("\n.x.tar")))
    )
    docs = table(spark, sf, "documents").select("doc_id", name.alias("name"))
    return docs.select("doc_id", fn.extension("name").alias("extension"))


@query(
    """SELECT doc_id, concat('2026-08-', lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0'), 'T',
        lpad(CAST(doc_id % 12 AS VARCHAR), 2, '0'), ':30:00Z') AS instant FROM documents"""
)
def times_without_seconds(spark, sf):
    """Hours and minutes alone, in UTC and with an offset."""
    day = F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")
    hour = F.col("doc_id") % 12
    at = F.when(
        F.col("doc_id") % 2 == 0,
        F.concat(F.lit("2026-08-"), day, F.lit("T"), F.lpad(hour.cast("string"), 2, "0"), F.lit(":30Z")),
    ).otherwise(
        F.concat(
            F.lit("2026-08-"), day, F.lit("T"), F.lpad((hour + 2).cast("string"), 2, "0"),
            F.lit(":30+02:00"),
        )
    )
    docs = table(spark, sf, "documents").select("doc_id", at.alias("at"))
    return docs.select("doc_id", fn.to_utc("at", "null").alias("instant"))


_SIZE = "1048574 + doc_id % 5"


@query(
    f"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 50 = 3 THEN {_SIZE}
        ELSE octet_length(encode(text)) END AS bytes FROM documents)
      SELECT doc_id AS idx, CASE WHEN bytes > 1048576 THEN 'content_too_large' END AS error,
      CASE WHEN bytes <= 1048576 THEN bytes END AS bytes FROM d"""
)
def records_at_the_size_cap(spark, sf):
    """Every document as a record; of some the content is about as large as the cap."""
    content = f"CASE WHEN doc_id % 50 = 3 THEN repeat('x', CAST({_SIZE} AS INT)) ELSE text END"
    docs = table(spark, sf, "documents").selectExpr(
        "doc_id AS idx", "'documents' AS stream", "concat('f/', doc_id) AS path",
        # MIME line breaks are no part of the contract
        f"translate(base64(CAST({content} AS BINARY)), '\\r\\n', '') AS content_base64",
        "CAST(NULL AS STRING) AS sha256", "CAST(NULL AS STRING) AS modified_at",
    )
    rows = validate_records(materialize(docs, "large-records"), "/R", max_mb=1)
    return rows.select("idx", "error", F.octet_length("content").cast("long").alias("bytes"))


@query(
    """SELECT file_id, CASE WHEN starts_with(path_display, '/Source-Root/')
        THEN substr(path_display, 14) ELSE ltrim(path_display, '/') END AS path,
      size * 1000 AS size, 'too_large' AS reason FROM fx_source WHERE size * 1000 > 2097152""",
    uses="fx_source",
)
def skipped_transfers(spark, sf):
    """The account of files over the cap of a migration."""
    files = file_listing(spark, sf, "fx_source").withColumn("size", F.col("size") * 1000)
    return skipped_files(files, "/Source-Root", 2)


@query(
    """SELECT file_id, name, size * 1000 AS size, 'too_large' AS reason FROM fx_source
      WHERE size * 1000 > 2097152
        AND lower(regexp_extract(name, '([.][^.]+)$', 1)) IN ('.pdf', '.docx', '.html')""",
    uses="fx_source",
)
def skipped_extractions(spark, sf):
    """The account of documents over the cap of extraction."""
    files = fixture(spark, sf, "fx_source").withColumn("size", F.col("size") * 1000)
    return skipped_documents(files, SUFFIXES, 2)


@query(
    """SELECT * FROM (VALUES ('non_empty', 'file_id', 0), ('non_empty', 'rev', (SELECT count(*)
          FROM fx_version_state WHERE starts_with(path, 'old/'))),
        ('non_empty', 'content_hash', 0), ('unique', 'file_id', 0))
        AS v(rule, "column", violations)""",
    uses="fx_version_state",
)
def extraction_state_contract(spark, sf):
    """Extraction state may lack paths; revisions were emptied below ``old/`` on purpose."""
    state = fixture(spark, sf, "fx_version_state").select(
        "file_id",
        "content_hash",
        F.when(F.col("path").startswith("old/"), F.lit("")).otherwise(F.col("rev")).alias("rev"),
        F.when(~F.col("path").startswith("gone/"), F.col("path")).alias("path"),
    )
    return check_state(state.select("file_id", "rev", "content_hash", "path"), "extraction")


@query(
    f"""WITH {_PROPERTIES}, {_LINKS}, {_ACL}, {_CONTENTS}
      SELECT * FROM (VALUES
        ('entries', 6, (SELECT count(*) FROM fx_change_log WHERE entry_type = 'folder')),
        ('files', 2, (SELECT count(*) FROM fx_source WHERE size % 2 = 0)),
        ('folders', 2, (SELECT count(*) FROM fx_change_log WHERE entry_type = 'folder'
          AND ends_with(name, '3'))),
        ('file_properties', 5, (SELECT count(*) FROM p WHERE field_name = 'size')),
        ('shared_links', 10, (SELECT count(*) FROM l WHERE link_type = 'folder')),
        ('shared_folders', 2, (SELECT count(*) FROM fx_shared_folders WHERE access_type = 'viewer')),
        ('sharing_acl', 6, (SELECT count(*) FROM acl WHERE principal_type = 'group')),
        ('file_contents', 7, (SELECT count(*) FROM f WHERE extraction_status = 'failed')))
        AS v(stream, rules, violations)""",
    uses=" ".join(
        dict.fromkeys(
            "fx_change_log fx_source fx_properties fx_templates fx_links fx_members"
            f" fx_shared_folders {EXTRACTED}".split()
        )
    ),
)
def stream_contracts(spark, sf):
    """The declared contract of every stream, each with one of its rules broken on purpose."""

    def broken(rows, column, bad, value=None):
        """The column changed where ``bad`` holds; nothing else is touched."""
        return rows.withColumn(column, F.when(F.expr(bad), F.lit(value)).otherwise(F.col(column)))

    changes = change_listing(spark, sf)
    links = relations.shared_links(_landed_links(spark, sf), "/web")
    streams = {
        "entries": broken(relations.entries(changes), "operation", "entry_type = 'folder'", "touch"),
        "files": broken(relations.files(file_listing(spark, sf, "fx_source")), "name", "size % 2 = 0"),
        "folders": broken(relations.folders(changes), "id", "endswith(name, '3')"),
        "file_properties": broken(_properties(spark, sf), "field_name", "field_name = 'size'"),
        "shared_links": broken(links, "link_type", "link_type = 'folder'", "directory"),
        "shared_folders": broken(
            relations.shared_folders(_landed_folders(spark, sf)), "name", "access_type = 'viewer'"
        ),
        "sharing_acl": broken(_acl(spark, sf), "principal_type", "principal_type = 'group'", "crowd"),
        "file_contents": broken(
            _contents(spark, sf), "extraction_status", "extraction_status = 'failed'", "broken"
        ),
    }
    found = None
    for stream, rows in streams.items():
        counts = check_contract(rows, stream).agg(
            F.count("*").alias("rules"), F.sum("violations").alias("violations")
        )
        counted = counts.select(F.lit(stream).alias("stream"), "rules", "violations")
        found = counted if found is None else found.unionByName(counted)
    return found
