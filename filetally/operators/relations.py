"""Keyed relations from landed listings and sharing data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.functions.keys import acl_key, entry_key, property_key
from filetally.functions.paths import in_scope
from filetally.functions.times import to_utc
from filetally.guards import non_empty, require
from filetally.operators.keyed import dedupe_strict, named
from filetally.schemas import CONTRACTS
from filetally.session import require_utc

FILE_ONLY = ["rev", "client_modified", "server_modified", "size", "content_hash",
             "is_downloadable"]


def entries(listing: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Change log: files and folders are upserts keyed by id, deletions are keyed by path.

    ``keep`` names listing columns to carry along, such as page and ordinal.
    """
    known = require(
        listing, "entry_type IN ('file', 'folder', 'deleted')", "'Unsupported metadata type.'"
    )
    identity = "CASE WHEN entry_type = 'deleted' THEN path_lower ELSE id END"
    return known.selectExpr(
        f"{entry_key('entry_type', identity)} AS entry_key",
        "entry_type",
        "CASE WHEN entry_type = 'deleted' THEN 'delete' ELSE 'upsert' END AS operation",
        "CASE WHEN entry_type <> 'deleted' THEN id END AS id",
        "name",
        "path_lower",
        "path_display",
        *[f"CASE WHEN entry_type = 'file' THEN {c} END AS {c}" for c in FILE_ONLY],
        "CASE WHEN entry_type = 'folder' THEN shared_folder_id END AS shared_folder_id",
        *keep,
    )


def _snapshot(listing: DataFrame, kind: str, stream: str) -> DataFrame:
    """Live rows of one kind; the sharing struct is cut to the fields that kind has."""
    schema = CONTRACTS[stream].schema
    shared = schema["sharing_info"].dataType
    parts = ", ".join(f"sharing_info.{f} AS {f}" for f in shared.names)
    cut = f"CASE WHEN sharing_info IS NOT NULL THEN struct({parts}) END AS sharing_info"
    return listing.where(f"entry_type = '{kind}'").selectExpr(
        *[cut if c == "sharing_info" else c for c in schema.names]
    )


def files(listing: DataFrame) -> DataFrame:
    """Current files with their sharing and lock structs."""
    return _snapshot(listing, "file", "files")


def folders(listing: DataFrame) -> DataFrame:
    """Current folders with their sharing struct."""
    return _snapshot(listing, "folder", "folders")


def file_properties(listing: DataFrame, templates: DataFrame) -> DataFrame:
    """One row per file, template and field; identical duplicates dropped, conflicts fail.

    ``templates`` holds the account's own few templates; whether it is small enough to
    broadcast is left to its measured size.
    """
    groups = listing.where("entry_type = 'file'").selectExpr(
        "id AS file_id", "name AS file_name", "path_lower", "path_display",
        "explode(property_groups) AS g",
    )
    groups = require(
        groups, non_empty("g.template_id"), "'A property group has no template ID.'"
    )
    rows = groups.selectExpr(
        "file_id", "file_name", "path_lower", "path_display", "g.template_id AS template_id",
        "explode(g.fields) AS f",
    )
    rows = require(
        rows,
        non_empty("file_id", "f.name"),
        f"CASE WHEN {non_empty('file_id')} THEN 'A file property has no field name.' "
        "ELSE 'A file property has no file ID.' END",
    )
    keyed = rows.selectExpr(
        f"{property_key('file_id', 'template_id', 'f.name')} AS property_key",
        "file_id", "file_name", "path_lower", "path_display", "template_id",
        "CAST(NULL AS STRING) AS field_id", "f.name AS field_name", "f.value AS field_value",
    )
    distinct = dedupe_strict(
        keyed, ["property_key"], named("Conflicting duplicate file properties for ", "property_key")
    )
    names = templates.groupBy("template_id").agg(F.max("name").alias("template_name"))
    return distinct.join(names, "template_id", "left").select(
        *CONTRACTS["file_properties"].schema.names
    )


def shared_links(links: DataFrame, root: str = "") -> DataFrame:
    """Links whose target lies in ``root``; without a target path a link is never in scope."""
    require_utc(links.sparkSession)
    kind = "CASE WHEN kind IN ('file', 'folder') THEN kind ELSE 'other' END"
    hidden = "CAST(NULL AS STRING) AS path_display"
    p = "link_permissions"
    return links.where(in_scope("path_lower", root)).selectExpr(
        "url AS link_key",
        "url AS link_id",
        "url",
        "id AS target_id",
        "name",
        "path_lower",
        hidden,
        f"{kind} AS link_type",
        f"{p}.resolved_visibility AS visibility",
        f"{to_utc('expires')} AS expires",
        f"{p}.allow_download AS allow_download",
        f"{p}.effective_audience AS effective_audience",
        f"{p}.requested_visibility AS requested_visibility",
        f"{p}.link_access_level AS access_level",
        f"struct(id, {kind} AS type, path_lower, {hidden}) AS target",
        f"struct({p}.requested_visibility AS requested_visibility, "
        f"{p}.resolved_visibility AS effective_visibility, "
        f"{p}.link_access_level AS link_access_level, {p}.allow_download AS allow_download) "
        "AS settings",
        f"{to_utc('client_modified')} AS client_modified",
        f"{to_utc('server_modified')} AS server_modified",
        "rev",
        "size",
        "team_member_info",
        "content_owner_team_info",
    )


def shared_folders(landed: DataFrame) -> DataFrame:
    """All shared folders of the account; deliberately not limited to a root."""
    return landed.select(*CONTRACTS["shared_folders"].schema.names)


# Stable identity of a member: account or group id, else e-mail (never for groups).
_IDENTITY = """CASE WHEN principal_type = 'other' THEN kind
    WHEN principal_id <> '' THEN principal_id
    WHEN principal_type <> 'group' AND email <> '' THEN email END"""


def sharing_acl(folders: DataFrame, members: DataFrame, root: str = "") -> DataFrame:
    """One row per in-scope shared folder and principal.

    ``members`` is one row per member. The access level is not part of the key, so two
    levels for one principal are a conflict and fail the job.
    """
    scoped = require(
        folders.where(in_scope("path_lower", root)),
        non_empty("shared_folder_id"),
        "'An in-scope shared folder has no stable ID.'",
    ).select("shared_folder_id", "path_lower", "path_display")
    listed = members.selectExpr(
        "shared_folder_id", "principal_type", f"{_IDENTITY} AS identity", "principal_id", "email",
        "display_name", "same_team", "access_level", "is_inherited",
    )
    # Inner join with one row per folder: a hot folder only makes the members side uneven,
    # which adaptive execution splits. Only members of folders in scope are tested.
    joined = require(
        listed.join(scoped, "shared_folder_id"),
        "identity IS NOT NULL",
        "concat('A shared-folder ', principal_type, ' has no stable identity.')",
    )
    rows = joined.selectExpr(
        f"{acl_key('shared_folder_id', 'principal_type', 'identity')} AS acl_key",
        "shared_folder_id AS resource_id",
        "'shared_folder' AS resource_type",
        "path_lower",
        "path_display",
        "principal_type",
        "CASE WHEN principal_type <> 'other' THEN principal_id END AS principal_id",
        "CASE WHEN principal_type NOT IN ('other', 'group') THEN email END AS principal_email",
        "CASE WHEN principal_type <> 'other' THEN display_name END AS principal_display_name",
        "access_level",
        "is_inherited",
        "CASE WHEN principal_type <> 'other' THEN NOT same_team END AS is_external",
    )
    return dedupe_strict(
        rows,
        ["acl_key"],
        named("Conflicting duplicate sharing records for resource ",
              "substring_index(acl_key, '|', 1)"),
    )


def scope_rejects(df: DataFrame, path: str, root: str = "") -> DataFrame:
    """Rows a scoped relation skips, with the reason: no path, or outside the root."""
    reason = f"CASE WHEN {non_empty(path)} THEN 'outside_root' ELSE 'missing_path' END"
    return df.where(f"NOT {in_scope(path, root)}").withColumn("reject_reason", F.expr(reason))
