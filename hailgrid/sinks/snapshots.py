"""All-or-nothing publication of several tables, with optimistic concurrency.

Each publication writes its tables below a version directory of its own, and then commits one line of the
manifest, which makes them visible together. Readers see the previous version until then, and a failed
publication is never seen. A publisher may name the version it has read: if another one has been published since,
its own is refused (``Conflict``) and its files are left to ``expire``. Without an expected version it publishes
after whatever is there. A reader names a version, or gets the last; a version never changes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailgrid.sinks.commits import Conflict, commit, file_system, history, path_exists, remove_tree

MANIFEST_DDL = "folder STRING, tables ARRAY<STRING>, published_at TIMESTAMP"
_ATTEMPTS = 50


def versions(spark: SparkSession, root: str) -> DataFrame:
    """Every published version: number, its folder, its tables, its time."""
    return history(spark, f"{root}/manifest", MANIFEST_DDL)


def snapshot_replace(
    spark: SparkSession, root: str, tables: dict[str, DataFrame], expected: int | None = None
) -> int:
    """Publish ``tables`` as the new current version and return its number.

    With ``expected`` (0 for none) it must come right after that version.
    """
    if expected is not None and current_version(spark, root, missing=0) != expected:
        raise Conflict(f"version {expected} of {root} is not the current one")
    folder = uuid.uuid4().hex
    for name, table in tables.items():
        table.write.parquet(f"{root}/versions/{folder}/{name}")
    now = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")).first()[0]
    record = {"folder": folder, "tables": list(tables), "published_at": now}
    for _ in range(_ATTEMPTS):
        base = current_version(spark, root, missing=0) if expected is None else expected
        try:
            return commit(spark, f"{root}/manifest", base, record)
        except Conflict:
            if expected is not None:
                raise
    raise Conflict(f"{root} is published too often by others")


def current_version(spark: SparkSession, root: str, missing: int | None = None) -> int:
    version = versions(spark, root).agg(F.max("version")).first()[0]
    if version is None and missing is None:
        raise RuntimeError(f"nothing has been published below {root}")
    return missing if version is None else version


def read_snapshot(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """One table of a version, the current one unless another is named."""
    wanted = current_version(spark, root) if version is None else version
    line = versions(spark, root).where(F.col("version") == wanted).first()
    if line is None or table not in line["tables"]:
        raise RuntimeError(f"{root} has no table {table} in version {wanted}")
    path = f"{root}/versions/{line['folder']}/{table}"
    if not path_exists(spark, path):
        raise RuntimeError(f"version {wanted} of {root} has expired")
    return spark.read.parquet(path)


def expire(spark: SparkSession, root: str, keep: int) -> int:
    """Delete the tables of all but the last ``keep`` versions, and those that were never published.

    Returns the number of folders deleted. Not to be called while a publication is being written.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    kept = {r["folder"] for r in versions(spark, root).orderBy(F.desc("version")).limit(keep).collect()}
    store, where = file_system(spark, f"{root}/versions")
    if not store.exists(where):
        return 0
    names = [status.getPath().getName() for status in store.listStatus(where)]
    old = [name for name in names if name not in kept]
    for name in old:
        remove_tree(spark, f"{root}/versions/{name}")
    return len(old)
