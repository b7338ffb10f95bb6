"""Jobs that build the datasets: full refresh of a period, and rebuild of one month.

Raw trips are cleaned once; demand and business trips read the clean trips that were stored. Every later
step reads what the step before has written, so a lost executor costs at most the current step.

Below the root: clean_trips, hourly_demand, features, business_trips, zone_hour_daily (all by year and
month), and star/ with dim_zone, dim_hour, dim_payment, dim_date, fact_demand, fact_trips.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from hailgrid.fixed import PICKUP, ZONE_COLUMNS
from hailgrid.functions.calendar import month_span, shift_month
from hailgrid.operators.business import business_from_clean
from hailgrid.operators.cleaning import clean_trips
from hailgrid.operators.demand import SLOT, complete_grid, hourly_demand, zone_hour_daily
from hailgrid.operators.history import month_features, sliced_demand_features
from hailgrid.operators.star import (
    dim_date,
    dim_hour,
    dim_payment,
    dim_zone,
    fact_demand,
    fact_trips,
)
from hailgrid.sinks.writers import (
    ZONE_HOUR_ORDER,
    sink_month,
    sink_months,
    sink_overwrite,
    sink_zone_hour_daily,
)


def app_zones(zones: DataFrame) -> DataFrame:
    """The zone columns that reports use, by borough and zone."""
    return zones.select(*ZONE_COLUMNS).orderBy("Borough", "Zone")


def stored_months(spark: SparkSession, path: str, *months: tuple[int, int]) -> DataFrame:
    """Only the given months of a month-partitioned dataset (partition pruning)."""
    wanted = " OR ".join(f"(year = {y} AND month = {m})" for y, m in months)
    return spark.read.parquet(path).where(wanted)


def refresh_period(
    spark: SparkSession, trips: DataFrame, zones: DataFrame, root: str, start: datetime, end: datetime
) -> None:
    """Rebuild everything for the whole months [start, end), replacing what is stored."""
    sink_months(clean_trips(trips, start, end), f"{root}/clean_trips", PICKUP, True)
    clean = spark.read.parquet(f"{root}/clean_trips").drop("year", "month")
    sink_months(hourly_demand(clean), f"{root}/hourly_demand", "pickup_hour", True)
    demand = spark.read.parquet(f"{root}/hourly_demand").select(*SLOT, "demand")
    grid = complete_grid(demand, zones, str(start), str(end - timedelta(hours=1)))
    sink_months(sliced_demand_features(grid), f"{root}/features", "pickup_hour", True)
    sink_months(business_from_clean(clean), f"{root}/business_trips", "pickup_date", True)
    features = spark.read.parquet(f"{root}/features")
    business = spark.read.parquet(f"{root}/business_trips")
    full_refresh_star(spark, zones, features, business, root)


def rebuild_month(
    spark: SparkSession, trips: DataFrame, zones: DataFrame, root: str, year: int, month: int
) -> None:
    """Rebuild one month from raw trips; safe to repeat, also when no trips are left in it."""
    own = (year, month)
    sink_month(clean_trips(trips, *month_span(*own)), f"{root}/clean_trips", PICKUP, own)
    clean = stored_months(spark, f"{root}/clean_trips", own).drop("year", "month")
    sink_month(hourly_demand(clean), f"{root}/hourly_demand", "pickup_hour", own)
    rebuild_month_features(spark, zones, root, year, month)
    sink_month(business_from_clean(clean), f"{root}/business_trips", "pickup_date", own)
    features = stored_months(spark, f"{root}/features", (year, month))
    business = stored_months(spark, f"{root}/business_trips", (year, month))
    _write_star(spark, zones, features, business, root, (year, month))


def rebuild_month_features(
    spark: SparkSession, zones: DataFrame, root: str, year: int, month: int
) -> None:
    """Recompute a month's features from stored demand of this and the previous month."""
    months = shift_month(year, month, -1), (year, month)
    demand = stored_months(spark, f"{root}/hourly_demand", *months).select(*SLOT, "demand")
    sink_month(month_features(demand, zones, year, month), f"{root}/features", "pickup_hour", (year, month))


def has_month(spark: SparkSession, root: str, year: int, month: int) -> bool:
    return not stored_months(spark, f"{root}/hourly_demand", (year, month)).isEmpty()


def full_refresh_star(
    spark: SparkSession, zones: DataFrame, features: DataFrame, business: DataFrame, root: str
) -> None:
    """Rebuild all dimensions and facts."""
    _write_star(spark, zones, features, business, root, None)


def _write_star(spark, zones, features, business, root: str, month: tuple[int, int] | None) -> None:
    """Write the star tables from the given slices; without a month they replace everything."""
    daily_path, star = f"{root}/zone_hour_daily", f"{root}/star"
    rows = zone_hour_daily(features, zones)
    if month is None:
        sink_zone_hour_daily(rows, daily_path, True)
        daily = spark.read.parquet(daily_path)
    else:
        sink_month(rows, daily_path, "date", month, ZONE_HOUR_ORDER)
        daily = stored_months(spark, daily_path, month)
    sink_overwrite(dim_zone(zones), f"{star}/dim_zone")
    sink_overwrite(dim_hour(spark), f"{star}/dim_hour")
    sink_overwrite(dim_payment(spark), f"{star}/dim_payment")
    for table, name, at in (
        (dim_date(daily), "dim_date", "full_date"),
        (fact_demand(daily), "fact_demand", "pickup_date"),
        (fact_trips(business), "fact_trips", "pickup_date"),
    ):
        if month is None:
            sink_months(table, f"{star}/{name}", at, True)
        else:
            sink_month(table, f"{star}/{name}", at, month)
