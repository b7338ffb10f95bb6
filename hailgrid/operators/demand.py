"""Zone-by-hour demand: counting, the complete grid, and its report form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailgrid.fixed import PICKUP, ZONE_COLUMNS
from hailgrid.functions.calendar import iso_weekday, weekday_name, zoneless_hour
from hailgrid.operators.cleaning import (
    FILTER_WORDS,
    filter_chronological,
    filter_time_window,
    parted,
    surviving_keys,
)

SLOT = ["LocationID", "pickup_hour"]


def hourly_demand(trips: DataFrame) -> DataFrame:
    """Pickups per zone and hour. The hour is kept without a time zone."""
    return _per_zone_hour(trips, F.count(F.lit(1)))


def _per_zone_hour(trips: DataFrame, demand: Column) -> DataFrame:
    hour = zoneless_hour(PICKUP)
    return trips.groupBy(
        F.col("PULocationID").alias("LocationID"), hour.alias("pickup_hour")
    ).agg(demand.alias("demand"))


def clean_hourly_demand(trips: DataFrame, start, end, filter_words: int = FILTER_WORDS) -> DataFrame:
    """Hourly demand of the cleaned trips, straight from raw trips.

    Equal to counting ``clean_trips``. Zone and hour are part of the trip key, so one aggregate per key both finds
    the reversals among the suspects and carries their count. Trips are never joined with keys, and copies of a
    hot key are combined before the shuffle.
    """
    in_time = filter_chronological(filter_time_window(trips, start, end))
    clear, suspects = parted(in_time, filter_words)
    counted = hourly_demand(clear).unionByName(_per_zone_hour(surviving_keys(suspects), F.sum("records")))
    return counted.groupBy(*SLOT).agg(F.sum("demand").alias("demand"))


def zone_hours(zones: DataFrame, first_hour: str, last_hour: str) -> DataFrame:
    """Every zone at every hour from ``first_hour`` to ``last_hour`` inclusive.

    Each zone row generates its own days and each day its hours, so there is no join. The days are
    spread over the session's shuffle partitions, each of which then makes the hours of its days.
    """
    last = f"TIMESTAMP_NTZ '{last_hour}'"
    days = F.expr(f"sequence(DATE '{str(first_hour)[:10]}', DATE '{str(last_hour)[:10]}', INTERVAL 1 DAY)")
    hours = F.expr("sequence(cast(day AS TIMESTAMP_NTZ), cast(day AS TIMESTAMP_NTZ) + INTERVAL 23 HOURS, INTERVAL 1 HOUR)")
    tasks = int(zones.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        zones.select("LocationID", F.explode(days).alias("day"))
        .repartition(tasks, "LocationID", "day")
        .select("LocationID", F.explode(hours).alias("pickup_hour"))
        .where(f"pickup_hour >= TIMESTAMP_NTZ '{first_hour}' AND pickup_hour <= {last}")
    )


def complete_grid(demand: DataFrame, zones: DataFrame, first_hour: str, last_hour: str) -> DataFrame:
    """Demand on the full zone-hour grid, zero where nothing was picked up."""
    observed = demand.select(*SLOT, "demand")
    return zone_hours(zones, first_hour, last_hour).join(observed, SLOT, "left").fillna(0, ["demand"])


def with_zone_attributes(demand: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone attributes joined to demand; unknown zones keep empty attributes."""
    return demand.join(zones.select(*ZONE_COLUMNS), "LocationID", "left")


def zone_hour_daily(demand: DataFrame, zones: DataFrame) -> DataFrame:
    """Demand by zone, date and hour with zone attributes and weekday labels."""
    at = "pickup_hour"
    return with_zone_attributes(demand.select(*SLOT, "demand"), zones).select(
        *ZONE_COLUMNS,
        F.to_date(at).alias("date"),
        F.hour(at).alias("hour"),
        iso_weekday(at).alias("weekday_number"),
        weekday_name(at).alias("weekday"),
        "demand",
    )


def sorted_zone_hour_daily(demand: DataFrame, zones: DataFrame) -> DataFrame:
    return zone_hour_daily(demand, zones).orderBy("LocationID", "date", "hour")
