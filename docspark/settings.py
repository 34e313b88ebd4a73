"""Session settings the library relies on, and the shared folder it may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def builder(app: str = "docspark") -> SparkSession.Builder:
    """Session builder with the settings queries are written for."""
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )


_local_root: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """A new folder below `spark.checkpoint.dir`.

    Where that is unset a temporary folder is used, but in local mode only: on a
    cluster the executors do not share one.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root = _local_root or tempfile.mkdtemp(prefix="docspark-")
    return f"{root.rstrip('/')}/docspark-{uuid.uuid4().hex}"
