"""The driver's tables in the shape of trips, zones and monthly demand.

The same text serves both engines: ``spark_sql`` and ``duckdb_sql`` differ in identifier quotes,
in how a number of minutes or hours is added to a timestamp, and in how an array is unfolded.
"""

from __future__ import annotations

from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession

from hailgrid.functions.storage import new_folder
from hailgrid.models.evaluation import filter_full_history
from hailgrid.operators.business import business_from_clean, business_predicate, trip_metrics
from hailgrid.operators.cleaning import (
    clean_trips,
    drop_reversals,
    filter_chronological,
    filter_time_window,
)
from hailgrid.operators.demand import complete_grid, hourly_demand, zone_hour_daily
from hailgrid.operators.history import demand_features
from hailgrid.operators.star import (
    dim_date,
    dim_hour,
    dim_payment,
    dim_zone,
    fact_demand,
    fact_trips,
)

START, END = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
LAST_HOUR = "2024-01-31 23:00:00"

TRIPS = """
WITH base AS (
  SELECT event_id,
         CAST(event_id % 2 + 1 AS INT) AS "VendorID",
         ts AS tpep_pickup_datetime,
         {DROPOFF} AS tpep_dropoff_datetime,
         CAST(user_id % 25 AS INT) AS "PULocationID",
         CASE WHEN event_id % 150 = 0 THEN NULL
              ELSE CAST(user_id * 7 % 25 AS INT) END AS "DOLocationID",
         CAST(event_id % 7 AS BIGINT) AS payment_type,
         CAST(event_id * 37 % 2500 AS DOUBLE) / CAST(100 AS DOUBLE) AS trip_distance,
         CASE WHEN event_id % 83 = 0 THEN -value ELSE value END AS fare_amount,
         CASE WHEN event_id % 7 = 1 THEN CAST(event_id % 9 AS DOUBLE)
              ELSE CAST(0 AS DOUBLE) END AS tip_amount,
         CAST(event_id % 5 AS DOUBLE) AS tolls_amount,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
         CASE WHEN event_id % 7 = 0 THEN NULL
              WHEN user_id % 25 % 8 = 0 THEN CAST(1.75 AS DOUBLE)
              ELSE CAST(0 AS DOUBLE) END AS "Airport_fee",
         CAST(0.75 AS DOUBLE) AS cbd_congestion_fee,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 6 AS BIGINT) END AS passenger_count,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 4 + 1 AS BIGINT) END AS "RatecodeID",
         CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'Y' ELSE 'N' END
              AS store_and_fwd_flag,
         CAST(event_id % 3 AS DOUBLE) AS extra,
         CAST(0.5 AS DOUBLE) AS mta_tax,
         CAST(1 AS DOUBLE) AS improvement_surcharge
  FROM {events}
), signed AS (
  -- every trip once; some a second time as a reversal, some as an exact copy
  SELECT *, {SIGNS} AS sgn FROM base
)
SELECT "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, "PULocationID", "DOLocationID",
       payment_type, trip_distance, sgn * fare_amount AS fare_amount,
       sgn * (fare_amount + tip_amount + tolls_amount) AS total_amount, tip_amount, tolls_amount,
       congestion_surcharge, "Airport_fee", cbd_congestion_fee, passenger_count, "RatecodeID",
       store_and_fwd_flag, extra, mta_tax, improvement_surcharge
FROM signed
WHERE sgn IS NOT NULL
"""

ZONES = """
SELECT n_nationkey AS "LocationID", r_name AS "Borough", n_name AS "Zone",
       CASE WHEN n_nationkey % 8 = 0 THEN 'Airports'
            WHEN n_nationkey % 3 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

MONTHLY_DEMAND = """
SELECT CAST(l_suppkey % 5 AS INT) AS "LocationID", {SHIP_HOUR} AS pickup_hour, COUNT(*) AS demand
FROM {lineitem}
GROUP BY 1, 2
"""

# Forecast requests: every order asks for the zone of its customer at its order time.
REQUESTS = """
SELECT o_orderkey AS request_id, CAST(o_custkey % 7 AS INT) AS location_id,
       {ORDER_HOUR} AS forecast_datetime
FROM {orders}
"""

_SIGNS = """CAST(1 AS DOUBLE), CASE WHEN event_id % 50 = 0 THEN CAST(-1 AS DOUBLE) END,
         CASE WHEN event_id % 61 = 0 THEN CAST(1 AS DOUBLE) END"""
SPARK_WORDS = {
    "SIGNS": f"explode(array({_SIGNS}))",
    "DROPOFF": "timestampadd(MINUTE, CAST(event_id % 90 AS INT) - 1, ts)",
    "SHIP_HOUR": "timestampadd(HOUR, CAST(l_orderkey % 24 AS INT), l_shipdate)",
    "ORDER_HOUR": "timestampadd(HOUR, CAST(o_orderkey % 24 AS INT), o_orderdate)",
}
DUCKDB_WORDS = {
    "SIGNS": f"unnest([{_SIGNS}])",
    "DROPOFF": "ts + to_minutes(CAST(event_id % 90 AS INTEGER) - 1)",
    "SHIP_HOUR": "l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER))",
    "ORDER_HOUR": "o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))",
}


SOURCE_TABLES = ["events", "nation", "region", "lineitem", "orders"]


def spark_sql(text: str, tables: tuple[str, ...]) -> str:
    """Table names stay as {placeholders} that ``spark.sql`` binds to DataFrames."""
    return text.format(**SPARK_WORDS, **{t: f"{{{t}}}" for t in tables}).replace('"', "`")


def duckdb_sql(text: str) -> str:
    return text.format(**DUCKDB_WORDS, **{t: t for t in SOURCE_TABLES})


@lru_cache(maxsize=4)
def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """One set of frames per session and directory, so that files are listed once."""
    return Inputs(spark, sf_dir)


class Inputs:
    """Lazily built frames over one data directory, shared by the checks."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def query(self, text: str, *tables: str) -> DataFrame:
        return self.spark.sql(spark_sql(text, tables), **{t: self.table(t) for t in tables})

    def folder(self, label: str) -> str:
        return new_folder(self.spark, label)

    @cached_property
    def trips(self) -> DataFrame:
        return self.query(TRIPS, "events")

    @cached_property
    def zones(self) -> DataFrame:
        return self.query(ZONES, "nation", "region")

    @cached_property
    def monthly_demand(self) -> DataFrame:
        return self.query(MONTHLY_DEMAND, "lineitem")

    @cached_property
    def requests(self) -> DataFrame:
        return self.query(REQUESTS, "orders")

    @cached_property
    def in_window(self) -> DataFrame:
        return filter_time_window(self.trips, START, END)

    @cached_property
    def timed(self) -> DataFrame:
        return filter_chronological(self.in_window)

    @cached_property
    def clean(self) -> DataFrame:
        return clean_trips(self.trips, START, END)

    @cached_property
    def valid(self) -> DataFrame:
        """All trips without reversals, whatever their time."""
        return drop_reversals(self.trips)

    @cached_property
    def standard(self) -> DataFrame:
        """Business trips before the outlier filter, with ratios."""
        return trip_metrics(business_predicate(self.clean))

    @cached_property
    def business(self) -> DataFrame:
        return business_from_clean(self.clean)

    @cached_property
    def hourly(self) -> DataFrame:
        return hourly_demand(self.clean)

    @cached_property
    def grid(self) -> DataFrame:
        return complete_grid(self.hourly, self.zones, START, LAST_HOUR)

    @cached_property
    def features(self) -> DataFrame:
        return demand_features(self.grid)

    @cached_property
    def model_rows(self) -> DataFrame:
        return filter_full_history(self.features)

    @cached_property
    def daily(self) -> DataFrame:
        return zone_hour_daily(self.grid, self.zones)

    @cached_property
    def fact_demand(self) -> DataFrame:
        return fact_demand(self.daily)

    @cached_property
    def fact_trips(self) -> DataFrame:
        return fact_trips(self.business)

    @cached_property
    def dim_zone(self) -> DataFrame:
        return dim_zone(self.zones)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dim_date(self.daily)

    @cached_property
    def dim_hour(self) -> DataFrame:
        return dim_hour(self.spark)

    @cached_property
    def dim_payment(self) -> DataFrame:
        return dim_payment(self.spark)
