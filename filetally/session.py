"""Session settings the operators rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from filetally.errors import ConfigurationError

# Every value is a session default; a cluster's own settings are never overridden.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def builder(app: str = "filetally") -> SparkSession.Builder:
    """A session builder carrying the defaults above."""
    made = SparkSession.builder.appName(app)
    for name, value in DEFAULTS.items():
        made = made.config(name, value)
    return made


def require_utc(spark: SparkSession) -> None:
    """Timestamps are rendered in the session zone, so that zone has to be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in {"UTC", "Etc/UTC", "Z", "+00:00"}:
        raise ConfigurationError("spark.sql.session.timeZone must be UTC.")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names, in local mode a new one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ConfigurationError("spark.checkpoint.dir must name a folder all executors reach.")
    local = tempfile.mkdtemp(prefix="filetally-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/filetally/{label}-{uuid.uuid4().hex}"


def materialize(df, label: str, stored: dict | None = None):
    """Cut lineage through a written table, which survives the loss of executors.

    ``stored`` holds options of the Parquet writer.
    """
    path = scratch(df.sparkSession, label)
    df.write.options(**(stored or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
