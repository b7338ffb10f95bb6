"""The monthly increment as a stream of raw files.

New files name the months they touch. Each touched month is rebuilt from all raw trips of that
month, and the month after it gets new features, because its first lags look back into the
touched month. Rebuilding overwrites whole month partitions, so replaying a batch is harmless.
The checkpoint records which files are done; with ``maxFilesPerTrigger`` a backfill proceeds
file by file, and a file that arrives late simply rebuilds its month again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hailgrid.fixed import PICKUP
from hailgrid.functions.calendar import shift_month
from hailgrid.plans.refresh import has_month, rebuild_month, rebuild_month_features
from hailgrid.sources.contract import validate_trip_schema

Month = tuple[int, int]


def touched_months(trips: DataFrame, first: Month | None = None, last: Month | None = None) -> list[Month]:
    """Months with pickups, in order, inside the optional inclusive bounds.

    Stray clock errors can date a trip years away; the bounds keep such months out.
    """
    at = F.col(PICKUP)
    months = trips.where(at.isNotNull()).select(F.year(at).alias("y"), F.month(at).alias("m"))
    found = sorted((row["y"], row["m"]) for row in months.distinct().collect())
    return [x for x in found if (first is None or x >= first) and (last is None or x <= last)]


def increment(
    spark: SparkSession, trips: DataFrame, zones: DataFrame, root: str, months: list[Month]
) -> None:
    """Rebuild the given months, and the features of the stored months right after them."""
    for year, month in months:
        rebuild_month(spark, trips, zones, root, year, month)
    for following in sorted({shift_month(y, m, 1) for y, m in months} - set(months)):
        if has_month(spark, root, *following):
            rebuild_month_features(spark, zones, root, *following)


def stream_month_increment(
    spark: SparkSession,
    raw: str,
    schema: T.StructType,
    zones: DataFrame,
    root: str,
    checkpoint: str,
    first: Month | None = None,
    last: Month | None = None,
    files_per_batch: int = 1,
    **trigger,
) -> StreamingQuery:
    """Watch ``raw`` for trip files and keep the datasets below ``root`` up to date."""
    files = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(raw)
    )
    validate_trip_schema(files)

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        trips = session.read.schema(schema).parquet(raw)
        increment(session, trips, zones, root, touched_months(batch, first, last))

    return (
        files.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(apply)
        .start()
    )
