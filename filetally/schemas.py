"""Declared schemas of landed data and of the record streams. Nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

STRING, LONG, BOOLEAN = T.StringType(), T.LongType(), T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def complete(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the shape of ``schema``; columns it lacks become null."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) "
            f"AS {f.name}"
            for f in schema.fields
        ]
    )


PROPERTY_GROUPS = T.ArrayType(
    struct(template_id=STRING, fields=T.ArrayType(struct(name=STRING, value=STRING)))
)

# One wide nullable struct for the file / folder / deleted union, told apart by entry_type.
ENTRY = struct(
    entry_type=STRING,
    id=STRING,
    name=STRING,
    path_lower=STRING,
    path_display=STRING,
    rev=STRING,
    client_modified=STRING,
    server_modified=STRING,
    size=LONG,
    content_hash=STRING,
    is_downloadable=BOOLEAN,
    has_explicit_shared_members=BOOLEAN,
    shared_folder_id=STRING,
    sharing_info=struct(
        read_only=BOOLEAN,
        parent_shared_folder_id=STRING,
        modified_by=STRING,
        shared_folder_id=STRING,
        traverse_only=BOOLEAN,
        no_access=BOOLEAN,
    ),
    file_lock_info=struct(
        is_lockholder=BOOLEAN,
        lockholder_name=STRING,
        lockholder_account_id=STRING,
        created=STRING,
    ),
    property_groups=PROPERTY_GROUPS,
)

# Landed listing, one row per page; ``first_ordinal`` numbers its first entry in the listing.
LISTING_PAGE = struct(
    page=LONG,
    first_ordinal=LONG,
    cursor=STRING,
    has_more=BOOLEAN,
    entries=T.ArrayType(ENTRY),
)

# Landed listing, one row per entry: filters on it reach the Parquet scan.
LISTING_ROW = T.StructType(
    [T.StructField("page", LONG), T.StructField("ordinal", LONG), *ENTRY.fields]
)

TEAM = struct(id=STRING, name=STRING)

LINK = struct(
    kind=STRING,
    url=STRING,
    id=STRING,
    name=STRING,
    path_lower=STRING,
    expires=STRING,
    link_permissions=struct(
        resolved_visibility=STRING,
        requested_visibility=STRING,
        allow_download=BOOLEAN,
        effective_audience=STRING,
        link_access_level=STRING,
    ),
    client_modified=STRING,
    server_modified=STRING,
    rev=STRING,
    size=LONG,
    team_member_info=struct(display_name=STRING, member_id=STRING, team_info=TEAM),
    content_owner_team_info=TEAM,
)

FOLDER_POLICY = struct(
    acl_update_policy=STRING,
    shared_link_policy=STRING,
    member_policy=STRING,
    resolved_member_policy=STRING,
    viewer_info_policy=STRING,
)

SHARED_FOLDER = struct(
    shared_folder_id=STRING,
    folder_id=STRING,
    name=STRING,
    path_lower=STRING,
    path_display=STRING,
    access_type=STRING,
    is_inside_team_folder=BOOLEAN,
    is_team_folder=BOOLEAN,
    preview_url=STRING,
    time_invited=STRING,
    parent_shared_folder_id=STRING,
    owner_team=TEAM,
    policy=FOLDER_POLICY,
)

_USER = struct(account_id=STRING, email=STRING, display_name=STRING, same_team=BOOLEAN)

# Landed members page of one shared folder.
MEMBERS = struct(
    shared_folder_id=STRING,
    users=T.ArrayType(struct(access_type=STRING, is_inherited=BOOLEAN, user=_USER)),
    groups=T.ArrayType(
        struct(
            access_type=STRING,
            is_inherited=BOOLEAN,
            group=struct(group_id=STRING, group_name=STRING, same_team=BOOLEAN),
        )
    ),
    invitees=T.ArrayType(
        struct(
            access_type=STRING,
            is_inherited=BOOLEAN,
            invitee=struct(tag=STRING, email=STRING),
            user=_USER,
        )
    ),
    others=T.ArrayType(struct(access_type=STRING, is_inherited=BOOLEAN, kind=STRING)),
)

# One member per row: what the lists of a members page flatten to.
MEMBER_ROW = struct(
    shared_folder_id=STRING,
    principal_type=STRING,
    principal_id=STRING,
    email=STRING,
    display_name=STRING,
    same_team=BOOLEAN,
    access_level=STRING,
    is_inherited=BOOLEAN,
    kind=STRING,
)

TEMPLATE = struct(template_id=STRING, name=STRING)

EXTRACTION_RESULT = struct(
    file_id=STRING,
    rev=STRING,
    content_hash=STRING,
    status=STRING,
    markdown=STRING,
    error_type=STRING,
    error_code=STRING,
    error_message=STRING,
)

TRANSFER_STATE = struct(file_id=STRING, path=STRING, rev=STRING, content_hash=STRING)
EXTRACTION_STATE = struct(file_id=STRING, rev=STRING, content_hash=STRING, path=STRING)

OPERATION = struct(
    operation=STRING,
    file_id=STRING,
    old_path=STRING,
    old_content_hash=STRING,
    new_path=STRING,
    new_content_hash=STRING,
)

FILE_RECORD = struct(
    idx=LONG, stream=STRING, path=STRING, content_base64=STRING, sha256=STRING, modified_at=STRING
)

STAGED_REFERENCE = struct(
    idx=LONG,
    staging_file_url=STRING,
    relative_path=STRING,
    file_size_bytes=LONG,
    sha256=STRING,
    client_modified=STRING,
)

_SIDE = struct(
    file_id=STRING,
    rev=STRING,
    size=LONG,
    content_hash=STRING,
    client_modified=STRING,
    server_modified=STRING,
)

REPORT = struct(
    type=STRING,
    path=STRING,
    status=STRING,
    reason=STRING,
    content=struct(status=STRING, reason=STRING),
    namespace=struct(status=STRING, reason=STRING),
    metadata=struct(client_modified=struct(status=STRING, source=STRING, destination=STRING)),
    source=_SIDE,
    destination=_SIDE,
)

SUMMARY = struct(
    type=STRING,
    total_paths=LONG,
    matched=LONG,
    missing=LONG,
    mismatched=LONG,
    extra_destination=LONG,
    errors=LONG,
    metadata_mismatches=struct(client_modified=LONG),
)


@dataclass(frozen=True)
class Contract:
    """Rules of one record stream: columns and types, required ones, closed value sets."""

    schema: T.StructType
    required: tuple[str, ...]
    values: dict[str, tuple[str, ...]] = field(default_factory=dict)
    extra_columns: bool = False


_FILE_COLUMNS = struct(
    name=STRING,
    path_lower=STRING,
    path_display=STRING,
    id=STRING,
    rev=STRING,
    client_modified=STRING,
    server_modified=STRING,
    size=LONG,
    content_hash=STRING,
    is_downloadable=BOOLEAN,
)

TARGET = struct(id=STRING, type=STRING, path_lower=STRING, path_display=STRING)
LINK_SETTINGS = struct(
    requested_visibility=STRING,
    effective_visibility=STRING,
    link_access_level=STRING,
    allow_download=BOOLEAN,
)

CONTRACTS: dict[str, Contract] = {
    "entries": Contract(
        struct(
            entry_key=STRING,
            entry_type=STRING,
            operation=STRING,
            id=STRING,
            name=STRING,
            path_lower=STRING,
            path_display=STRING,
            rev=STRING,
            client_modified=STRING,
            server_modified=STRING,
            size=LONG,
            content_hash=STRING,
            is_downloadable=BOOLEAN,
            shared_folder_id=STRING,
        ),
        ("entry_key", "entry_type", "operation", "name"),
        {"entry_type": ("file", "folder", "deleted"), "operation": ("upsert", "delete")},
        extra_columns=True,
    ),
    "files": Contract(
        T.StructType(
            [
                *_FILE_COLUMNS.fields,
                T.StructField("has_explicit_shared_members", BOOLEAN),
                T.StructField(
                    "sharing_info",
                    struct(read_only=BOOLEAN, parent_shared_folder_id=STRING, modified_by=STRING),
                ),
                T.StructField("file_lock_info", ENTRY["file_lock_info"].dataType),
            ]
        ),
        ("id", "name"),
    ),
    "folders": Contract(
        struct(
            name=STRING,
            path_lower=STRING,
            path_display=STRING,
            id=STRING,
            shared_folder_id=STRING,
            sharing_info=struct(
                read_only=BOOLEAN,
                parent_shared_folder_id=STRING,
                shared_folder_id=STRING,
                traverse_only=BOOLEAN,
                no_access=BOOLEAN,
            ),
        ),
        ("id", "name"),
    ),
    "file_properties": Contract(
        struct(
            property_key=STRING,
            file_id=STRING,
            file_name=STRING,
            path_lower=STRING,
            path_display=STRING,
            template_id=STRING,
            template_name=STRING,
            field_id=STRING,
            field_name=STRING,
            field_value=STRING,
        ),
        ("property_key", "file_id", "file_name", "template_id", "field_name"),
    ),
    "shared_links": Contract(
        struct(
            link_key=STRING,
            link_id=STRING,
            url=STRING,
            target_id=STRING,
            name=STRING,
            path_lower=STRING,
            path_display=STRING,
            link_type=STRING,
            visibility=STRING,
            expires=STRING,
            allow_download=BOOLEAN,
            effective_audience=STRING,
            requested_visibility=STRING,
            access_level=STRING,
            target=TARGET,
            settings=LINK_SETTINGS,
            client_modified=STRING,
            server_modified=STRING,
            rev=STRING,
            size=LONG,
            team_member_info=LINK["team_member_info"].dataType,
            content_owner_team_info=TEAM,
        ),
        ("link_key", "link_id", "url", "name", "target", "link_type", "settings", "target.type"),
        {
            "link_type": ("file", "folder", "other"),
            "target.type": ("file", "folder", "other"),
        },
    ),
    "shared_folders": Contract(SHARED_FOLDER, ("shared_folder_id", "name")),
    "sharing_acl": Contract(
        struct(
            acl_key=STRING,
            resource_id=STRING,
            resource_type=STRING,
            path_lower=STRING,
            path_display=STRING,
            principal_type=STRING,
            principal_id=STRING,
            principal_email=STRING,
            principal_display_name=STRING,
            access_level=STRING,
            is_inherited=BOOLEAN,
            is_external=BOOLEAN,
        ),
        ("acl_key", "resource_id", "resource_type", "principal_type"),
        {
            "resource_type": ("shared_folder",),
            "principal_type": ("user", "group", "invitee", "other"),
        },
    ),
    "file_contents": Contract(
        struct(
            file_id=STRING,
            rev=STRING,
            content_hash=STRING,
            name=STRING,
            path_lower=STRING,
            path_display=STRING,
            size=LONG,
            client_modified=STRING,
            server_modified=STRING,
            content_format=STRING,
            markdown=STRING,
            extraction_status=STRING,
            error_type=STRING,
            error_code=STRING,
            error_details=struct(type=STRING, message=STRING),
            error_message=STRING,
        ),
        ("file_id", "name", "size", "content_format", "extraction_status"),
        {
            "content_format": ("markdown",),
            "extraction_status": ("succeeded", "failed", "timed_out"),
        },
    ),
}
