"""Reading trips, zones, datasets and metric files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hailgrid.fixed import TRIP_FILE_PREFIX, ZONE_LOOKUP_DDL
from hailgrid.functions.calendar import month_span
from hailgrid.operators.cleaning import filter_time_window
from hailgrid.sources.contract import validate_trip_schema


def scan_trips(
    spark: SparkSession, *paths: str, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Trips of one or more Parquet files or directories, optionally of one month only.

    Year and month come together or not at all. The month is a predicate on the pickup time
    that the Parquet reader uses to skip row groups, plus the ``year``/``month`` directories
    when the dataset has them.
    """
    if (year is None) != (month is None):
        raise ValueError("give both year and month, or neither")
    bounds = month_span(year, month) if month is not None else None
    trips = spark.read.parquet(*paths)
    validate_trip_schema(trips)
    if bounds is None:
        return trips
    if {"year", "month"} <= set(trips.columns):
        trips = trips.where(f"year = {year} AND month = {month}")
    return filter_time_window(trips, *bounds)


def trip_month_file(root: str, year: int, month: int) -> str:
    """Location of one month's file below ``root``."""
    month_span(year, month)
    return f"{root.rstrip('/')}/{TRIP_FILE_PREFIX}{year}-{month:02d}.parquet"


def scan_trips_month(spark: SparkSession, root: str, year: int, month: int) -> DataFrame:
    """One monthly file, whole: late pickups of other months are the window filter's business."""
    trips = spark.read.parquet(trip_month_file(root, year, month))
    validate_trip_schema(trips)
    return trips


def scan_trips_range(spark: SparkSession, root: str, year: int) -> DataFrame:
    """All monthly files of a year below ``root``."""
    trips = spark.read.parquet(f"{root.rstrip('/')}/{TRIP_FILE_PREFIX}{year}-*.parquet")
    validate_trip_schema(trips)
    return trips


def scan_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup. Types are declared; the text ``N/A`` is a value, not a null."""
    return spark.read.schema(ZONE_LOOKUP_DDL).csv(path, header=True)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


METRIC_SCHEMAS = {
    "historical_metrics": "model STRING, mae DOUBLE, rmse DOUBLE",
    "feature_importance": "feature STRING, importance DOUBLE",
    "future_summary": "model STRING, mae DOUBLE, rmse DOUBLE, backtest_months INT",
    "future_backtest": "model STRING, test_month DATE, train_rows BIGINT, test_rows BIGINT, "
    "mae DOUBLE, rmse DOUBLE",
}


def scan_metrics_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A metrics file of a known kind; wrong columns or no rows are errors."""
    declared = spark.read.schema(METRIC_SCHEMAS[kind])
    header = spark.read.csv(path, header=True).columns
    metrics = declared.csv(path, header=True)
    if header != metrics.columns:
        raise RuntimeError(f"{kind} has columns {header}, expected {metrics.columns}")
    if metrics.isEmpty():
        raise RuntimeError(f"{kind} is empty")
    return metrics

