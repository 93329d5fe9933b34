"""The documented warehouse queries over the record streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetally.guards import quote


def expiring_links(shared_links: DataFrame) -> DataFrame:
    return shared_links.where("expires IS NOT NULL").selectExpr(
        "url", "target.path_lower AS path_lower", "expires"
    )


def public_downloadable_links(shared_links: DataFrame) -> DataFrame:
    return shared_links.where(
        "settings.effective_visibility = 'public' AND settings.allow_download"
    ).selectExpr("url", "target.type AS target_type", "target.path_lower AS path_lower")


def user_access(sharing_acl: DataFrame) -> DataFrame:
    return sharing_acl.where("principal_type = 'user'").select(
        "resource_id", "path_display", "principal_type", "principal_email", "access_level"
    )


def succeeded_documents(file_contents: DataFrame) -> DataFrame:
    return file_contents.where("extraction_status = 'succeeded'").select(
        "file_id", "path_display", "markdown"
    )


def failures_by_code(file_contents: DataFrame) -> DataFrame:
    failed = file_contents.where("extraction_status = 'failed'")
    return failed.groupBy("error_code").agg(F.expr("count(1) AS documents"))


def template_properties(file_properties: DataFrame, template_name: str) -> DataFrame:
    return file_properties.where(f"template_name = {quote(template_name)}").select(
        "file_id", "path_display", "template_name", "field_name", "field_value"
    )


def documents_per_value(file_properties: DataFrame, field_name: str) -> DataFrame:
    """Distinct files per value of one field.

    The distinct count is planned on (value, file) pairs first, so a value that dominates
    the data is counted from partial results.
    """
    chosen = file_properties.where(f"field_name = {quote(field_name)}")
    return chosen.groupBy("field_value").agg(
        F.count_distinct("file_id").alias("documents")
    )
