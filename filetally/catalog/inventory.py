"""Keyed relations, sharing data, dedup and contract checks over the benchmark tables."""

from pyspark.sql import functions as F

from filetally.catalog.registry import change_listing, file_listing, query
from filetally.fixtures import fixture
from filetally.operators import relations, warehouse
from filetally.operators.contract import check_contract, check_state
from filetally.operators.keyed import dedupe_replay, dedupe_strict, duplicate_keys
from filetally.schemas import LINK, SHARED_FOLDER, complete
from filetally.session import scratch
from filetally.sources.listing import (
    as_listing_rows,
    land_listing,
    read_listing,
    scope_listing,
)
from filetally.sources.sharing import read_links, read_members, read_shared_folders


@query(
    """SELECT page, ordinal, entry_type, name, lower(path_display) AS path_lower
      FROM fx_change_log WHERE entry_type <> 'deleted'""",
    uses="fx_change_log",
)
def listing_snapshot(spark, sf):
    """Landed as pages, read back flattened, without deletions."""
    path = scratch(spark, "listing-pages")
    land_listing(change_listing(spark, sf), path, page_size=100)
    return read_listing(spark, path, "/USERS", True, False, layout="pages").select(
        "page", "ordinal", "entry_type", "name", "path_lower"
    )


@query(
    """SELECT ordinal, entry_type, path_display FROM fx_change_log
      WHERE regexp_full_match(path_display, '/Users/U-7/[^/]+')""",
    uses="fx_change_log",
)
def listing_children(spark, sf):
    """Direct children of one folder: a prefix test the scan can use plus a depth test."""
    rows = scope_listing(change_listing(spark, sf), "/users/u-7", recursive=False)
    return rows.select("ordinal", "entry_type", "path_display")


_ENTRY = """SELECT ordinal,
  CASE entry_type WHEN 'deleted' THEN concat('deleted:', lower(path_display))
    ELSE concat(entry_type, ':', file_id) END AS entry_key, entry_type,
  CASE entry_type WHEN 'deleted' THEN 'delete' ELSE 'upsert' END AS operation,
  CASE WHEN entry_type <> 'deleted' THEN file_id END AS id, name,
  lower(path_display) AS path_lower, path_display,
  CASE WHEN entry_type = 'file' THEN rev END AS rev,
  CASE WHEN entry_type = 'file' THEN size END AS size,
  CASE WHEN entry_type = 'file' THEN content_hash END AS content_hash FROM fx_change_log"""
_ENTRY_COLUMNS = ["entry_key", "entry_type", "operation", "id", "name", "path_lower",
                  "path_display", "rev", "size", "content_hash"]


@query(_ENTRY, uses="fx_change_log")
def change_entries(spark, sf):
    return relations.entries(change_listing(spark, sf), keep=["ordinal"]).select(
        "ordinal", *_ENTRY_COLUMNS
    )


@query(
    f"""WITH e AS ({_ENTRY}), ranked AS (SELECT *, row_number() OVER (PARTITION BY entry_key
        ORDER BY ordinal DESC) AS rn FROM e)
      SELECT {', '.join(_ENTRY_COLUMNS)} FROM ranked WHERE rn = 1""",
    uses="fx_change_log",
)
def current_entries(spark, sf):
    """Replayed and updated keys converge to their last row."""
    log = relations.entries(change_listing(spark, sf), keep=["page", "ordinal"])
    return dedupe_replay(log, ["entry_key"], ["page", "ordinal"]).select(*_ENTRY_COLUMNS)


@query(
    """SELECT file_id AS id, name, lower(path_display) AS path_lower, path_display, rev,
      client_modified, size, content_hash FROM fx_source""",
    uses="fx_source",
)
def files_snapshot(spark, sf):
    return relations.files(file_listing(spark, sf, "fx_source")).select(
        "id", "name", "path_lower", "path_display", "rev", "client_modified", "size",
        "content_hash",
    )


@query(
    """SELECT file_id AS id, name, lower(path_display) AS path_lower, count(*) AS listed
      FROM fx_change_log WHERE entry_type = 'folder' GROUP BY ALL""",
    uses="fx_change_log",
)
def folders_snapshot(spark, sf):
    folders = relations.folders(change_listing(spark, sf))
    return folders.groupBy("id", "name", "path_lower").agg(F.count(F.lit(1)).alias("listed"))


def _property_listing(spark, sf):
    """Listing rows that carry one property each, the way a replayed listing repeats a file.

    Nothing is gathered per file, however many properties it has.
    """
    field = F.struct(F.col("field_name").alias("name"), F.col("field_value").alias("value"))
    group = F.struct("template_id", F.array(field).alias("fields"))
    return fixture(spark, sf, "fx_properties").select(
        F.lit("file").alias("entry_type"),
        F.col("file_id").alias("id"),
        F.col("file_name").alias("name"),
        F.concat(F.lit("/parts/"), F.col("file_id")).alias("path_lower"),
        F.concat(F.lit("/Parts/"), F.col("file_id")).alias("path_display"),
        F.array(group).alias("property_groups"),
    )


def _properties(spark, sf):
    templates = fixture(spark, sf, "fx_templates")
    return relations.file_properties(_property_listing(spark, sf), templates)


_PROPERTIES = """p AS (SELECT DISTINCT file_id || '|' || template_id || '|' || field_name
    AS property_key, file_id, file_name, concat('/parts/', file_id) AS path_lower,
    concat('/Parts/', file_id) AS path_display, template_id, t.name AS template_name,
    field_name, field_value
  FROM fx_properties LEFT JOIN fx_templates t USING (template_id))"""


@query(f"WITH {_PROPERTIES} SELECT * FROM p", uses="fx_properties fx_templates")
def file_properties(spark, sf):
    return _properties(spark, sf).drop("field_id")


@query(
    """SELECT file_id, count(*) AS groups, count(field_value) AS filled
      FROM fx_properties GROUP BY file_id""",
    uses="fx_properties",
)
def property_listing(spark, sf):
    """Listing rows with their nested property groups, written and read back as declared."""
    path = scratch(spark, "property-listing")
    as_listing_rows(_property_listing(spark, sf)).write.parquet(path)
    rows = read_listing(spark, path, "/Parts", include_deleted=False)
    fields = rows.select(F.col("id").alias("file_id"), F.explode("property_groups").alias("g"))
    fields = fields.select("file_id", F.explode("g.fields").alias("field"))
    return fields.groupBy("file_id").agg(
        F.count(F.lit(1)).alias("groups"), F.count("field.value").alias("filled")
    )


@query(
    f"""WITH {_PROPERTIES} SELECT file_id, path_display, template_name, field_name, field_value
      FROM p WHERE template_name = 'Template Brand#2'""",
    uses="fx_properties fx_templates",
)
def template_properties(spark, sf):
    return warehouse.template_properties(_properties(spark, sf), "Template Brand#2")


@query(
    f"""WITH {_PROPERTIES} SELECT field_value, count(DISTINCT file_id) AS documents
      FROM p WHERE field_name = 'type' GROUP BY field_value""",
    uses="fx_properties fx_templates",
)
def documents_per_value(spark, sf):
    return warehouse.documents_per_value(_properties(spark, sf), "type")


def _landed_links(spark, sf):
    raw = fixture(spark, sf, "fx_links")
    landed = raw.select(
        F.col("link_type").alias("kind"),
        "url",
        F.col("target_id").alias("id"),
        "name",
        F.lower("path_display").alias("path_lower"),
        "expires",
        F.struct(
            F.col("visibility").alias("resolved_visibility"),
            F.col("visibility").alias("requested_visibility"),
            F.col("allow_download").alias("allow_download"),
            F.lit(None).cast("string").alias("effective_audience"),
            F.lit("viewer").alias("link_access_level"),
        ).alias("link_permissions"),
    )
    path = scratch(spark, "links")
    complete(landed, LINK).write.parquet(path)
    return read_links(spark, path)


_LINKS = """l AS (SELECT url AS link_key, target_id, name, lower(path_display) AS path_lower,
    link_type, visibility, allow_download,
    CASE WHEN expires IS NOT NULL THEN '2026-12-31T22:00:00Z' END AS expires
  FROM fx_links WHERE starts_with(path_display, '/Web/'))"""


@query(f"WITH {_LINKS} SELECT * FROM l", uses="fx_links")
def shared_links(spark, sf):
    links = relations.shared_links(_landed_links(spark, sf), "/web")
    return links.select(
        "link_key",
        F.col("target.id").alias("target_id"),
        "name",
        F.col("target.path_lower").alias("path_lower"),
        F.col("target.type").alias("link_type"),
        F.col("settings.effective_visibility").alias("visibility"),
        "allow_download",
        "expires",
    )


@query(
    f"WITH {_LINKS} SELECT link_key AS url, path_lower, expires FROM l WHERE expires IS NOT NULL",
    uses="fx_links",
)
def expiring_links(spark, sf):
    return warehouse.expiring_links(relations.shared_links(_landed_links(spark, sf), "/web"))


@query(
    f"""WITH {_LINKS} SELECT link_key AS url, link_type AS target_type, path_lower FROM l
      WHERE visibility = 'public' AND allow_download""",
    uses="fx_links",
)
def public_downloadable_links(spark, sf):
    links = relations.shared_links(_landed_links(spark, sf), "/web")
    return warehouse.public_downloadable_links(links)


@query(
    """SELECT CASE WHEN path_display IS NULL THEN 'missing_path' ELSE 'outside_root' END
        AS reject_reason, count(*) AS links
      FROM fx_links WHERE path_display IS NULL OR NOT starts_with(path_display, '/Web/')
      GROUP BY ALL""",
    uses="fx_links",
)
def link_scope_rejects(spark, sf):
    rejects = relations.scope_rejects(_landed_links(spark, sf), "path_lower", "/Web")
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("links"))


def _landed_folders(spark, sf):
    raw = fixture(spark, sf, "fx_shared_folders").withColumn(
        "path_lower", F.lower("path_display")
    )
    path = scratch(spark, "shared-folders")
    complete(raw, SHARED_FOLDER).write.parquet(path)
    return read_shared_folders(spark, path)


@query(
    """SELECT shared_folder_id, name, lower(path_display) AS path_lower, access_type
      FROM fx_shared_folders""",
    uses="fx_shared_folders",
)
def shared_folders(spark, sf):
    return relations.shared_folders(_landed_folders(spark, sf)).select(
        "shared_folder_id", "name", "path_lower", "access_type"
    )


def _members(spark, sf):
    return fixture(spark, sf, "fx_members").withColumn("kind", F.lit(None).cast("string"))


@query(
    """SELECT shared_folder_id, principal_type, count(*) AS members, count(principal_id) AS ids
      FROM fx_members GROUP BY ALL""",
    uses="fx_members",
)
def member_lists(spark, sf):
    """Members landed in the three lists of member pages, read back and flattened."""
    m = _members(spark, sf)
    kind = F.col("principal_type")
    user = F.struct(
        F.col("principal_id").alias("account_id"), "email", "display_name", "same_team"
    ).alias("user")
    group = F.struct(
        F.col("principal_id").alias("group_id"), F.col("display_name").alias("group_name"),
        "same_team",
    ).alias("group")
    invitee = F.struct(F.lit("email").alias("tag"), "email").alias("invitee")
    common = [F.col("access_level").alias("access_type"), "is_inherited"]

    def only(name, *parts):
        return F.when(kind == name, F.array(F.struct(*common, *parts)))

    path = scratch(spark, "member-pages")
    m.select(
        "shared_folder_id",
        only("user", user).alias("users"),
        only("group", group).alias("groups"),
        only("invitee", invitee, user).alias("invitees"),
    ).write.parquet(path)
    return (
        read_members(spark, path)
        .groupBy("shared_folder_id", "principal_type")
        .agg(F.count(F.lit(1)).alias("members"), F.count("principal_id").alias("ids"))
    )


_ACL = """acl AS (SELECT DISTINCT m.shared_folder_id || '|' || principal_type || '|' ||
      coalesce(principal_id, email) AS acl_key, m.shared_folder_id AS resource_id,
    f.path_display, principal_type, principal_id, email AS principal_email,
    display_name AS principal_display_name, access_level, is_inherited,
    NOT same_team AS is_external
  FROM fx_members m JOIN fx_shared_folders f USING (shared_folder_id)
  WHERE starts_with(f.path_display, '/Shared/'))"""


def _acl(spark, sf):
    return relations.sharing_acl(_landed_folders(spark, sf), _members(spark, sf), "/shared")


@query(f"WITH {_ACL} SELECT * FROM acl", uses="fx_members fx_shared_folders")
def sharing_acl(spark, sf):
    return _acl(spark, sf).drop("resource_type", "path_lower")


@query(
    f"""WITH {_ACL} SELECT resource_id, path_display, principal_type, principal_email,
      access_level FROM acl WHERE principal_type = 'user'""",
    uses="fx_members fx_shared_folders",
)
def user_access(spark, sf):
    return warehouse.user_access(_acl(spark, sf))


@query(
    """SELECT CASE WHEN path_display IS NULL THEN 'missing_path' ELSE 'outside_root' END
        AS reject_reason, count(*) AS folders
      FROM fx_shared_folders WHERE path_display IS NULL
        OR NOT starts_with(path_display, '/Shared/') GROUP BY ALL""",
    uses="fx_shared_folders",
)
def folder_scope_rejects(spark, sf):
    rejects = relations.scope_rejects(_landed_folders(spark, sf), "path_lower", "/Shared")
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("folders"))


@query("SELECT DISTINCT * FROM fx_members", uses="fx_members")
def strict_dedup(spark, sf):
    """Identical copies go; a second version of a key would fail the job."""
    keyed = ["shared_folder_id", "principal_type", "principal_id", "email"]
    return dedupe_strict(fixture(spark, sf, "fx_members"), keyed)


@query(
    """SELECT file_id, count(*) AS copies FROM fx_change_log GROUP BY file_id
      HAVING count(*) > 1""",
    uses="fx_change_log",
)
def repeated_keys(spark, sf):
    return duplicate_keys(fixture(spark, sf, "fx_change_log"), ["file_id"])


@query(
    """SELECT * FROM (VALUES
        ('required', 'entry_key', 0), ('required', 'entry_type', 0), ('required', 'operation', 0),
        ('required', 'name', 0), ('allowed_values', 'entry_type', 0),
        ('allowed_values', 'operation', (SELECT count(*) FROM fx_change_log
          WHERE entry_type = 'folder'))) AS v(rule, "column", violations)""",
    uses="fx_change_log",
)
def entries_contract(spark, sf):
    """Folder rows are given an operation outside the closed set on purpose."""
    rows = relations.entries(change_listing(spark, sf)).withColumn(
        "operation",
        F.when(F.col("entry_type") == "folder", F.lit("touch")).otherwise(F.col("operation")),
    )
    return check_contract(rows, "entries")


@query(
    """SELECT * FROM (VALUES ('non_empty', 'file_id', 0), ('non_empty', 'rev', 0),
        ('non_empty', 'content_hash', 0), ('non_empty', 'path', 0),
        ('safe_path', 'path', (SELECT count(*) FROM fx_version_state
          WHERE starts_with(path, 'gone/'))), ('unique', 'file_id', 0))
        AS v(rule, "column", violations)""",
    uses="fx_version_state",
)
def state_contract(spark, sf):
    """State whose ``gone/`` paths were made absolute on purpose."""
    state = fixture(spark, sf, "fx_version_state").withColumn(
        "path", F.regexp_replace("path", "^gone/", "/gone/")
    )
    return check_state(state.select("file_id", "path", "rev", "content_hash"))
