"""Hourly demand as a stream.

Counts of zone-hours only ever grow by what new files hold, so every micro-batch adds its own counts to a
change log, and reading the log adds them up. No hour is ever closed: a file may come at any time and in any
order, as backfills of monthly files do. There is no state between batches besides the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hailgrid.operators.cleaning import filter_chronological
from hailgrid.operators.demand import SLOT, hourly_demand
from hailgrid.sinks.snapshots import current_version, read_snapshot, snapshot_replace


def stream_hourly_demand(trips: DataFrame) -> DataFrame:
    """The trips of a stream that count: those that do not end before they start."""
    return filter_chronological(trips)


def write_hourly_changes(trips: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Add the counts of every micro-batch to a change log below ``path``.

    A batch owns one directory and overwrites it when it is replayed, so a restart does not
    count anything twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        hourly_demand(batch).write.mode("overwrite").parquet(f"{path}/batches/batch_id={batch_id}")

    return (
        trips.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )


def _summary(spark: SparkSession, path: str) -> tuple[DataFrame | None, int, int]:
    """The published summary, if there is one, the last batch that it holds, and its version."""
    root = f"{path}/summaries"
    version = current_version(spark, root, missing=0)
    if not version:
        return None, -1, 0
    last = read_snapshot(spark, root, "through", version).first()["batch_id"]
    return read_snapshot(spark, root, "counts", version), last, version


def read_hourly_changes(spark: SparkSession, path: str) -> DataFrame:
    """The count of every zone-hour: the summary and the batches after it, added up."""
    summary, last, _ = _summary(spark, path)
    counts = _batches(spark, path).where(F.col("batch_id") > last).select(*SLOT, "demand")
    if summary is not None:
        counts = counts.unionByName(summary)
    return counts.groupBy(*SLOT).agg(F.sum("demand").alias("demand"))


def _batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", f"{path}/batches").parquet(f"{path}/batches/batch_id=*")


def compact_hourly_changes(spark: SparkSession, path: str) -> None:
    """Publish a summary of all batches so far; later reads need it and newer batches only.

    Batches and summaries that it covers can be deleted afterwards, except for the newest batch.
    """
    newest = _batches(spark, path).agg(F.max("batch_id").alias("batch_id"))
    _, last, version = _summary(spark, path)
    if newest.first()["batch_id"] > last:
        tables = {"counts": read_hourly_changes(spark, path), "through": newest}
        snapshot_replace(spark, f"{path}/summaries", tables, expected=version)
