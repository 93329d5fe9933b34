"""Reconciliation and repair over the benchmark tables."""

from pyspark.sql import functions as F

from filetally.catalog.registry import file_listing, query
from filetally.fixtures import INSTANT, table
from filetally.operators.reconcile import (
    reconcile,
    reconcile_tables,
    side_inventory,
    summarize,
)
from filetally.operators.repair import (
    check_drift,
    repair_actions,
    repair_outcomes,
    repair_summary,
    report_violations,
    validate_report,
)
from filetally.session import scratch
from filetally.sources.report import order_violations, read_report, report_lines, write_report

SIDES = "fx_source fx_destination"
_UTC = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"
_AT = INSTANT.format("client_modified")
# Report rows in SQL: two keyed sides, a full outer join, and the rows outside the root.
REPORT = f"""s AS (SELECT *, lower(substr(path_display, 14)) AS k,
    substr(path_display, 14) AS shown,
    {_AT} AS at FROM fx_source
    WHERE starts_with(path_display, '/Source-Root/')),
  d AS (SELECT *, lower(substr(path_display, 19)) AS k, substr(path_display, 19) AS shown,
    {_AT} AS at FROM fx_destination),
  j AS (SELECT coalesce(s.k, d.k) AS sort_key, coalesce(s.shown, d.shown) AS path,
      CASE WHEN s.k IS NULL THEN 'destination_only' WHEN d.k IS NULL THEN 'source_only'
        WHEN s.content_hash IS NULL OR d.content_hash IS NULL THEN 'missing_content_hash'
        WHEN s.size IS DISTINCT FROM d.size THEN 'size_mismatch'
        WHEN s.content_hash <> d.content_hash THEN 'content_hash_mismatch'
        ELSE 'matched' END AS reason,
      CASE WHEN s.k IS NULL OR d.k IS NULL THEN 'not_comparable'
        WHEN s.client_modified IS NULL AND d.client_modified IS NULL THEN 'not_comparable'
        WHEN s.client_modified IS NULL THEN 'source_missing'
        WHEN d.client_modified IS NULL THEN 'destination_missing'
        WHEN s.at IS NULL OR d.at IS NULL THEN 'not_comparable'
        WHEN s.at = d.at THEN 'matched' ELSE 'mismatched' END AS modified,
      s.at AS s_at, d.at AS d_at, s.file_id AS source_file_id, s.rev AS source_rev,
      s.size AS source_size, s.content_hash AS source_hash, d.file_id AS destination_file_id
    FROM s FULL OUTER JOIN d ON s.k = d.k
    UNION ALL SELECT format('~invalid-source-{{:08d}}', ordinal), path_display,
      'invalid_relative_path', 'not_comparable', {_AT}, NULL,
      file_id, rev, size, content_hash, NULL
    FROM fx_source WHERE NOT starts_with(path_display, '/Source-Root/')),
  r AS (SELECT *, CASE reason WHEN 'destination_only' THEN 'extra_destination'
      WHEN 'source_only' THEN 'missing' WHEN 'matched' THEN 'matched'
      WHEN 'missing_content_hash' THEN 'error' WHEN 'invalid_relative_path' THEN 'error'
      ELSE 'mismatched' END AS status FROM j)"""


def report(spark, sf):
    """The flagship: both inventories compared path by path."""
    return reconcile(
        side_inventory(file_listing(spark, sf, "fx_source"), "/source-root", "source"),
        side_inventory(
            file_listing(spark, sf, "fx_destination"), "/Destination-Root", "destination"
        ),
    )


def flat_report(rows):
    modified = "metadata.client_modified"
    return rows.select(
        "sort_key",
        "path",
        "status",
        "reason",
        F.col("content.reason").alias("content_reason"),
        F.col("namespace.status").alias("namespace_status"),
        F.col("namespace.reason").alias("namespace_reason"),
        F.col(f"{modified}.status").alias("modified_status"),
        F.col(f"{modified}.source").alias("modified_source"),
        F.col(f"{modified}.destination").alias("modified_destination"),
        F.col("source.file_id").alias("source_file_id"),
        F.col("source.client_modified").alias("source_modified"),
        F.col("destination.file_id").alias("destination_file_id"),
        F.col("destination.client_modified").alias("destination_modified"),
    )


@query(
    f"""WITH {REPORT} SELECT sort_key, path, status, reason,
      CASE WHEN status = 'matched' THEN 'content_match' ELSE reason END AS content_reason,
      CASE WHEN status IN ('mismatched', 'error') THEN 'not_comparable' ELSE status END
        AS namespace_status,
      CASE WHEN status IN ('missing', 'extra_destination') THEN reason END AS namespace_reason,
      modified AS modified_status,
      CASE WHEN modified = 'mismatched' THEN {_UTC.format('s_at')} END AS modified_source,
      CASE WHEN modified = 'mismatched' THEN {_UTC.format('d_at')} END AS modified_destination,
      source_file_id, {_UTC.format('s_at')} AS source_modified,
      destination_file_id, {_UTC.format('d_at')} AS destination_modified FROM r""",
    uses=SIDES,
)
def reconciliation_report(spark, sf):
    return flat_report(report(spark, sf))


_COUNTS = """CAST(count(*) AS BIGINT) AS total_paths,
  count(*) FILTER (status = 'matched') AS matched, count(*) FILTER (status = 'missing') AS missing,
  count(*) FILTER (status = 'mismatched') AS mismatched,
  count(*) FILTER (status = 'extra_destination') AS extra_destination,
  count(*) FILTER (status = 'error') AS errors,
  count(*) FILTER (modified = 'mismatched') AS modified_mismatches"""


def _flat_summary(summary):
    return summary.select(
        "total_paths",
        "matched",
        "missing",
        "mismatched",
        "extra_destination",
        "errors",
        F.col("metadata_mismatches.client_modified").alias("modified_mismatches"),
    )


@query(f"WITH {REPORT} SELECT {_COUNTS} FROM r", uses=SIDES)
def reconciliation_summary(spark, sf):
    return _flat_summary(summarize(report(spark, sf)))


@query(
    """SELECT sort_key, display_path, issue FROM (
        SELECT lower(substr(path_display, 14)) AS sort_key, substr(path_display, 14)
          AS display_path, false AS issue FROM fx_source
          WHERE starts_with(path_display, '/Source-Root/')
        UNION ALL SELECT format('~invalid-source-{:08d}', ordinal), path_display, true
          FROM fx_source WHERE NOT starts_with(path_display, '/Source-Root/'))""",
    uses="fx_source",
)
def source_inventory(spark, sf):
    side = side_inventory(file_listing(spark, sf, "fx_source"), "/Source-Root", "source")
    return side.rows.select("sort_key", "display_path", "issue")


@query(
    """SELECT coalesce(o.k, l.k) AS order_key,
      CASE WHEN o.k IS NULL THEN 'extra_destination' WHEN l.k IS NULL THEN 'missing'
        WHEN o.s IS DISTINCT FROM l.s THEN 'mismatched' ELSE 'matched' END AS status,
      CASE WHEN o.k IS NULL THEN 'destination_only' WHEN l.k IS NULL THEN 'source_only'
        WHEN o.s IS DISTINCT FROM l.s THEN 'line_status_mismatch' ELSE 'matched' END AS reason
    FROM (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders) o
    FULL OUTER JOIN (SELECT l_orderkey AS k, CASE WHEN min(l_linestatus) = max(l_linestatus)
        THEN min(l_linestatus) ELSE 'P' END AS s FROM lineitem GROUP BY l_orderkey) l
      ON o.k = l.k"""
)
def reconcile_order_status(spark, sf):
    """Any two keyed tables: the order status against the one its lines imply."""
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("order_key")).agg(
        F.when(F.min("l_linestatus") == F.max("l_linestatus"), F.min("l_linestatus"))
        .otherwise(F.lit("P"))
        .alias("line_status")
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("line_status")
    )
    return reconcile_tables(orders, lines, ["order_key"], ["line_status"])


def _stored(spark, sf):
    path = scratch(spark, "report")
    write_report(report(spark, sf), path)
    return read_report(spark, path)


@query(
    f"""WITH {REPORT} SELECT path, status, reason, modified AS modified_status,
      source_file_id, source_size FROM r""",
    uses=SIDES,
)
def stored_report(spark, sf):
    """Written sorted as JSON lines with its summary, then read back with declared types."""
    return _stored(spark, sf).details.select(
        "path",
        "status",
        "reason",
        F.col("metadata.client_modified.status").alias("modified_status"),
        F.col("source.file_id").alias("source_file_id"),
        F.col("source.size").alias("source_size"),
    )


@query(
    f"""WITH {REPORT}, n AS (SELECT *, row_number() OVER (ORDER BY sort_key) AS line FROM r)
      SELECT line, 'file' AS type, path, status FROM n
      UNION ALL SELECT count(*) + 1, 'summary', NULL, NULL FROM n""",
    uses=SIDES,
)
def stored_lines(spark, sf):
    """Every line of the stored report with its number: sorted details, then the summary."""
    path = scratch(spark, "report-lines")
    write_report(report(spark, sf), path)
    return report_lines(spark, path).select("line", "type", "path", "status")


@query(f"WITH {REPORT} SELECT {_COUNTS} FROM r", uses=SIDES)
def stored_summary(spark, sf):
    return _flat_summary(_stored(spark, sf).summary)


# Issue rows show an absolute path, which a report for repair must not hold.
_UNSAFE = "starts_with(path, '/')"


@query(
    f"""WITH {REPORT} SELECT 'invalid_relative_path' AS rule, count(*) AS rows FROM r
      WHERE {_UNSAFE} HAVING count(*) > 0""",
    uses=SIDES,
)
def repair_report_violations(spark, sf):
    return report_violations(report(spark, sf))


@query(
    f"""WITH {REPORT} SELECT 'row_after_summary' AS rule, count(*) AS rows FROM r
      WHERE sort_key >= 'fr' HAVING count(*) > 0""",
    uses=SIDES,
)
def repair_report_order(spark, sf):
    """A report in one file whose summary stands before rows that sort behind it."""
    path = scratch(spark, "disordered-report")
    rows = report(spark, sf).select("sort_key", "type", "path", "status")
    summary = spark.createDataFrame([("fr", "summary")], "sort_key string, type string")
    every = rows.unionByName(summary, allowMissingColumns=True)
    # One file is what is looked at here, and its sorted lines reach it by one task.
    every.repartition(1).sortWithinPartitions("sort_key", F.desc("type")).drop(
        "sort_key"
    ).write.json(path)
    return order_violations(report_lines(spark, path))


def _outcomes(spark, sf):
    """Repair of the valid part of the stored report against a listing that has moved on."""
    stored = _stored(spark, sf).details
    valid = validate_report(stored.where(~F.col("path").startswith("/")))
    listing = file_listing(spark, sf, "fx_source")
    number = F.col("ordinal")
    now = listing.withColumn(
        "rev", F.when(number % 15 == 3, F.lit("r-new")).otherwise(F.col("rev"))
    ).withColumn(
        "path_lower",
        F.when(number % 15 == 4, F.concat(F.col("path_lower"), F.lit(".moved")))
        .otherwise(F.col("path_lower")),
    )
    return repair_outcomes(check_drift(repair_actions(valid), now, "/Source-Root"))


_ACTIONS = f"""{REPORT}, a AS (SELECT path, status AS source_status,
    CASE WHEN status NOT IN ('missing', 'mismatched') THEN 'skipped'
      WHEN CAST(substr(source_file_id, 4) AS BIGINT) % 15 IN (3, 4) THEN 'error'
      WHEN status = 'missing' THEN 'uploaded' ELSE 'overwritten' END AS action
  FROM r WHERE NOT {_UNSAFE})"""


@query(f"WITH {_ACTIONS} SELECT path, action, source_status FROM a", uses=SIDES)
def repair_plan(spark, sf):
    return _outcomes(spark, sf)


@query(
    f"""WITH {_ACTIONS} SELECT count(*) FILTER (action = 'uploaded') AS uploaded,
      count(*) FILTER (action = 'overwritten') AS overwritten,
      count(*) FILTER (action = 'skipped') AS skipped,
      count(*) FILTER (action = 'error') AS errors FROM a""",
    uses=SIDES,
)
def repair_totals(spark, sf):
    return repair_summary(_outcomes(spark, sf)).drop("type")


@query(
    """SELECT CASE WHEN starts_with(path_display, '/Source-Root/')
        THEN 'usable' ELSE 'issue' END AS kind, count(*) AS files
      FROM fx_source GROUP BY ALL""",
    uses="fx_source",
)
def inventory_kinds(spark, sf):
    """Both views of one side: keyed files, checked for duplicates, and path issues."""
    side = side_inventory(file_listing(spark, sf, "fx_source"), "/Source-Root", "source")
    kinds = side.files.select(F.lit("usable").alias("kind")).unionByName(
        side.issues.select(F.lit("issue").alias("kind"))
    )
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("files"))
