"""Inputs derived from the benchmark tables, as SQL both Spark and DuckDB run unchanged.

A row missing on one side, a changed version or a moved path is part of the scenario an
operator has to tell apart. Every statement reads its whole table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_SUFFIX = (
    "CASE doc_id % 5 WHEN 0 THEN '.PDF' WHEN 1 THEN '.docx' WHEN 2 THEN '.html' "
    "WHEN 3 THEN '.txt' ELSE '' END"
)
_DAY = "lpad(CAST(doc_id % 28 + 1 AS STRING), 2, '0')"

SQL = {
    "fx_source": f"""
        SELECT concat('id:', doc_id) AS file_id, doc_id AS ordinal,
          concat('doc-', doc_id, {_SUFFIX}) AS name,
          concat(CASE WHEN doc_id % 50 = 11 THEN '/Elsewhere/' ELSE '/Source-Root/' END,
            upper(lang), '/', source, '/Doc-', doc_id, {_SUFFIX}) AS path_display,
          concat('r', doc_id % 7) AS rev, n_chars AS size, md5(text) AS content_hash,
          CASE WHEN doc_id % 20 = 2 THEN NULL WHEN doc_id % 20 = 12 THEN 'not-a-date'
            ELSE concat('2024-01-', {_DAY}, 'T10:00:00Z') END AS client_modified
        FROM documents""",
    "fx_destination": f"""
        SELECT concat('dst:', doc_id) AS file_id, doc_id AS ordinal,
          concat('/Destination-Root/', upper(lang), '/', source, '/doc-', doc_id, {_SUFFIX},
            CASE WHEN doc_id % 10 = 7 THEN '.extra' ELSE '' END) AS path_display,
          concat('d', doc_id % 7) AS rev,
          CASE WHEN doc_id % 10 = 4 THEN n_chars + 1 ELSE n_chars END AS size,
          CASE WHEN doc_id % 10 = 5 THEN md5(concat(text, 'x')) WHEN doc_id % 10 = 6 THEN NULL
            ELSE md5(text) END AS content_hash,
          CASE WHEN doc_id % 10 = 8 THEN concat('2024-01-', {_DAY}, 'T12:00:00+02:00')
            WHEN doc_id % 10 = 9 THEN concat('2024-02-', {_DAY}, 'T10:00:00Z')
            WHEN doc_id % 10 = 0 THEN NULL
            ELSE concat('2024-01-', {_DAY}, 'T10:00:00Z') END AS client_modified
        FROM documents WHERE doc_id % 10 <> 3""",
    "fx_version_state": f"""
        SELECT concat('id:', doc_id) AS file_id,
          concat(CASE WHEN doc_id % 8 = 2 THEN 'old/' ELSE '' END, upper(lang), '/', source,
            '/Doc-', doc_id, {_SUFFIX}) AS path,
          concat('r', CASE WHEN doc_id % 5 = 1 THEN 99 ELSE doc_id % 7 END) AS rev,
          md5(text) AS content_hash
        FROM documents WHERE doc_id % 9 <> 0
        UNION ALL
        SELECT concat('id:gone-', doc_id), concat('gone/', source, '/Doc-', doc_id), 'r0',
          md5(text) FROM documents WHERE doc_id % 20 = 5""",
    "fx_tombstones": f"""
        SELECT concat('old/', upper(lang), '/', source, '/Doc-', doc_id, {_SUFFIX}) AS path
        FROM documents WHERE doc_id % 8 = 2
        UNION ALL SELECT upper(concat('gone/', source, '/Doc-', doc_id)) FROM documents
          WHERE doc_id % 20 = 5
        UNION ALL SELECT concat('unknown/', doc_id) FROM documents WHERE doc_id % 40 = 1""",
    "fx_change_log": """
        SELECT event_id AS ordinal, CAST(floor(event_id / 100) AS BIGINT) AS page,
          concat('id:', user_id) AS file_id,
          CASE WHEN event_type = 'error' THEN 'deleted' WHEN event_type = 'signup' THEN 'folder'
            ELSE 'file' END AS entry_type,
          concat('u-', user_id) AS name, concat('/Users/U-', user_id, '/', event_type)
            AS path_display,
          concat('r', event_id) AS rev, CAST(floor(value) AS BIGINT) AS size,
          md5(concat('v', event_id)) AS content_hash
        FROM events""",
    "fx_shared_folders": """
        SELECT concat('sf:', n_nationkey) AS shared_folder_id, n_name AS name,
          CASE WHEN n_nationkey % 10 = 7 THEN NULL
            WHEN n_regionkey = 4 THEN concat('/Shared-Old/', n_name)
            ELSE concat('/Shared/', n_name) END AS path_display,
          CASE n_regionkey WHEN 0 THEN 'owner' WHEN 1 THEN 'editor' ELSE 'viewer' END
            AS access_type
        FROM nation""",
    "fx_members": """
        SELECT concat('sf:', c_nationkey) AS shared_folder_id,
          CASE WHEN c_acctbal < 0 THEN 'invitee' ELSE 'user' END AS principal_type,
          CASE WHEN c_acctbal < 0 THEN NULL ELSE concat('dbid:', c_custkey) END AS principal_id,
          lower(concat('c', c_custkey, '@example.com')) AS email, c_name AS display_name,
          CASE c_mktsegment WHEN 'BUILDING' THEN true WHEN 'FURNITURE' THEN false ELSE NULL END
            AS same_team,
          CASE c_custkey % 3 WHEN 0 THEN 'editor' WHEN 1 THEN 'viewer' ELSE 'owner' END
            AS access_level, c_custkey % 2 = 0 AS is_inherited
        FROM customer
        UNION ALL SELECT concat('sf:', s_nationkey), 'group', concat('g:', s_suppkey), NULL,
          s_name, s_suppkey % 2 = 0, 'viewer', false FROM supplier
        UNION ALL SELECT concat('sf:', s_nationkey), 'group', concat('g:', s_suppkey), NULL,
          s_name, s_suppkey % 2 = 0, 'viewer', false FROM supplier WHERE s_suppkey % 3 = 0""",
    "fx_properties": """
        SELECT concat('id:', p_partkey) AS file_id, p_name AS file_name,
          concat('ptid:', p_brand) AS template_id, 'type' AS field_name, p_type AS field_value
        FROM part
        UNION ALL SELECT concat('id:', p_partkey), p_name, concat('ptid:', p_brand), 'size',
          CASE WHEN p_size % 10 = 0 THEN NULL ELSE CAST(p_size AS STRING) END FROM part
        UNION ALL SELECT concat('id:', p_partkey), p_name, concat('ptid:', p_brand), 'type',
          p_type FROM part WHERE p_partkey % 10 = 0""",
    "fx_templates": """
        SELECT DISTINCT concat('ptid:', p_brand) AS template_id,
          CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE concat('Template ', p_brand) END AS name
        FROM part""",
    "fx_links": """
        SELECT url, concat('id:', page_id) AS target_id, concat('page-', page_id) AS name,
          CASE WHEN page_id % 9 = 4 THEN NULL
            WHEN page_id % 5 = 1 THEN concat('/Web-Old/p', page_id)
            ELSE concat('/Web/p', page_id) END AS path_display,
          CASE page_id % 3 WHEN 0 THEN 'file' WHEN 1 THEN 'folder' ELSE 'other' END AS link_type,
          CASE page_id % 4 WHEN 0 THEN 'public' WHEN 1 THEN 'team_only' WHEN 2 THEN 'password'
            ELSE NULL END AS visibility,
          page_id % 2 = 0 AS allow_download,
          CASE WHEN page_id % 6 = 0 THEN '2026-12-31T23:00:00+01:00' ELSE NULL END AS expires
        FROM pages""",
    "fx_extraction_results": """
        SELECT concat('id:', doc_id) AS file_id, concat('r', doc_id % 7) AS rev,
          md5(text) AS content_hash,
          CASE WHEN doc_id % 11 = 3 THEN 'failed' WHEN doc_id % 13 = 5 THEN 'timed_out'
            ELSE 'succeeded' END AS extraction_status,
          CASE WHEN doc_id % 11 = 3 OR doc_id % 13 = 5 THEN NULL ELSE text END AS markdown,
          CASE WHEN doc_id % 11 = 3 THEN CASE doc_id % 2 WHEN 0 THEN 'conversion_failure_error'
            ELSE 'limit_exceeded_error' END WHEN doc_id % 13 = 5 THEN 'timeout' ELSE NULL END
            AS error_type
        FROM documents""",
    "fx_write_log": """
        SELECT o_custkey % 10 AS run, o_orderkey AS idx,
          CASE WHEN o_orderkey % 10 = 9 THEN 'state' ELSE 'record' END AS kind,
          concat('f/', o_orderkey % 500, '.bin') AS path,
          CASE WHEN o_orderkey % 400 = 398 THEN true ELSE false END AS failed
        FROM orders""",
    "fx_operations": f"""
        SELECT doc_id AS idx, CASE WHEN doc_id % 3 = 0 THEN 'delete' ELSE 'move' END AS operation,
          concat('id:', doc_id) AS file_id,
          concat(upper(lang), '/', source, '/doc-', doc_id, {_SUFFIX}) AS old_path,
          CASE WHEN doc_id % 9 = 2 THEN 'stale' ELSE md5(text) END AS old_content_hash,
          CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 8 = 1
            THEN concat(upper(lang), '/', source, '/doc-', doc_id, {_SUFFIX}, '.extra')
            ELSE concat('moved/', doc_id, '.bin') END AS new_path,
          CASE WHEN doc_id % 3 = 0 THEN NULL ELSE md5(text) END AS new_content_hash
        FROM documents""",
    "fx_follow_ups": """
        SELECT o.idx + 1000000000 AS idx, o.operation, o.file_id, o.old_path,
          o.old_content_hash, o.new_path, o.new_content_hash
        FROM fx_operations o WHERE o.idx % 7 = 1
        UNION ALL SELECT o.idx + 2000000000, 'move', o.file_id, o.new_path, o.old_content_hash,
          concat('final/', o.idx, '.bin'), o.new_content_hash
        FROM fx_operations o WHERE o.idx % 3 <> 0 AND o.idx % 4 = 1""",
}

# SQL for the instant of a string, as a UTC timestamp: with an offset, and without one as UTC.
HAS_OFFSET = "regexp_matches({0}, '(Z|[+-][0-9]{{2}}:[0-9]{{2}})$')"
INSTANT = (
    f"CASE WHEN {HAS_OFFSET} THEN make_timestamp(epoch_us(TRY_CAST({{0}} AS TIMESTAMPTZ))) "
    "ELSE TRY_CAST({0} AS TIMESTAMP) END"
)

_RECORDS = """
    SELECT doc_id AS idx, CASE WHEN doc_id % 17 = 3 THEN 'other' ELSE 'documents' END AS stream,
      CASE doc_id % 19 WHEN 1 THEN concat('/abs/', doc_id) WHEN 2 THEN concat('a/../', doc_id)
        WHEN 3 THEN '' ELSE concat(lang, '/', source, '/', doc_id, '.bin') END AS path,
      CASE WHEN doc_id % 23 = 5 THEN 'not base64!' WHEN doc_id % 23 = 6 THEN 'SGVsbG8'
        ELSE {encode} END AS content_base64,
      CASE WHEN doc_id % 29 = 1 THEN 'ABC' WHEN doc_id % 29 = 2 THEN {hash}(concat(text, 'x'){bits})
        WHEN doc_id % 2 = 0 THEN NULL ELSE {hash}(text{bits}) END AS sha256,
      CASE WHEN doc_id % 31 = 1 THEN '2026-08-18 12:00:00Z'
        WHEN doc_id % 31 = 2 THEN '2026-08-18T12:00:00'
        WHEN doc_id % 31 = 3 THEN '2026-02-30T12:00:00Z' WHEN doc_id % 3 = 0 THEN NULL
        ELSE '2026-08-18T14:00:00+02:00' END AS modified_at
    FROM documents"""
SPARK_RECORDS = _RECORDS.format(
    encode=r"regexp_replace(base64(encode(text, 'UTF-8')), '\\s', '')", hash="sha2", bits=", 256"
)
DUCKDB_RECORDS = _RECORDS.format(encode="to_base64(encode(text))", hash="sha256", bits="")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Run a fixture statement over the tables of ``sf_dir``."""
    statement = SPARK_RECORDS if name == "fx_records" else SQL[name]
    inputs = {}
    for t in [*TABLES, *SQL]:
        if re.search(rf"FROM {t}\b", statement):
            statement = re.sub(rf"FROM {t}\b", f"FROM {{{t}}}", statement)
            inputs[t] = table(spark, sf_dir, t) if t in TABLES else fixture(spark, sf_dir, t)
    return spark.sql(statement, **inputs)


def as_ctes(*names: str) -> str:
    """The same fixtures as the opening of a DuckDB statement."""
    parts = [f"{n} AS ({DUCKDB_RECORDS if n == 'fx_records' else SQL[n]})" for n in names]
    return "WITH " + ",\n".join(parts)
