"""Sharing metadata: links, shared folders and the three member lists of each folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filetally.schemas import LINK, MEMBER_ROW, MEMBERS, SHARED_FOLDER


def read_links(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.schema(LINK).format(file_format).load(path)


def read_shared_folders(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.schema(SHARED_FOLDER).format(file_format).load(path)


def read_members(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Landed member pages, flattened to one row per member."""
    return flatten_members(spark.read.schema(MEMBERS).format(file_format).load(path))


def _member(principal: str, **given: str) -> str:
    """SQL struct of one member ``m`` in the shape every list is brought to."""
    values = {
        "principal_type": f"'{principal}'",
        "access_level": "m.access_type",
        "is_inherited": "m.is_inherited",
        **given,
    }
    fields = [f for f in MEMBER_ROW.fields if f.name != "shared_folder_id"]
    return ", ".join(
        f"CAST({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in fields
    )


_ACCOUNT = {
    "principal_id": "m.user.account_id",
    "display_name": "m.user.display_name",
    "same_team": "m.user.same_team",
}
_LISTS = {
    "users": _member("user", email="m.user.email", **_ACCOUNT),
    "groups": _member(
        "group",
        principal_id="m.group.group_id",
        display_name="m.group.group_name",
        same_team="m.group.same_team",
    ),
    # An invitation contributes its address only when it was made by e-mail.
    "invitees": _member(
        "invitee",
        email="CASE WHEN m.invitee.tag = 'email' THEN m.invitee.email END",
        **_ACCOUNT,
    ),
    "others": _member("other", kind="m.kind"),
}


def flatten_members(pages: DataFrame) -> DataFrame:
    """One row per member of any list; a page is scanned once, its lists are concatenated."""
    lists = ", ".join(
        f"coalesce(transform({name}, m -> struct({shape})), array())"
        for name, shape in _LISTS.items()
    )
    return pages.selectExpr("shared_folder_id", f"inline(concat({lists}))")
