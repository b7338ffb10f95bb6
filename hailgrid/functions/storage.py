"""The folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; in local mode a temporary folder if it is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="hailgrid-")
    return _local_folders[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
