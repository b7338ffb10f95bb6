"""Scans, filters, cleaning and business trips."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from hailgrid.fixed import DEMAND_COLUMNS, MONEY_COLUMNS
from hailgrid.operators import business as b
from hailgrid.operators import cleaning as c
from hailgrid.operators import profiling as p
from hailgrid.operators.sampling import threshold
from hailgrid.operators.upsert import dedupe_by_key, upsert_by_key
from hailgrid.plans.demand_queries import boroughs, list_zones, optional_dates, zones_of_borough
from hailgrid.plans.refresh import app_zones
from hailgrid.sources.contract import contract_report
from hailgrid.sources.readers import (
    scan_parquet,
    scan_trips,
    scan_trips_month,
    scan_trips_range,
    scan_zone_lookup,
)
from oracle.inputs import END, START
from oracle.registry import check
from oracle.sql import KEY

# One value per trip column, so that a check covers every column without wide output.
TRIP_SUMMARY = """SELECT "PULocationID", payment_type, COUNT(*) AS trips,
    COUNT("DOLocationID") AS with_destination, MIN(tpep_pickup_datetime) AS first_pickup,
    MAX(tpep_dropoff_datetime) AS last_dropoff,
    CAST(SUM(CAST(fare_amount AS DECIMAL(18,2))) AS DOUBLE) AS fares,
    CAST(SUM(CAST(trip_distance AS DECIMAL(18,2))) AS DOUBLE) AS miles
    FROM {0} GROUP BY 1, 2"""


def trip_summary(trips):
    return trips.groupBy("PULocationID", "payment_type").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count("DOLocationID").alias("with_destination"),
        F.min("tpep_pickup_datetime").alias("first_pickup"),
        F.max("tpep_dropoff_datetime").alias("last_dropoff"),
        F.sum(F.col("fare_amount").cast("decimal(18,2)")).cast("double").alias("fares"),
        F.sum(F.col("trip_distance").cast("decimal(18,2)")).cast("double").alias("miles"),
    )


def store_trips(t, name: str):
    """The trips as one monthly file, named like a raw trip file."""
    folder = t.folder("raw")
    t.trips.write.parquet(f"{folder}/{name}")
    return folder


@check("scan_trips_month", TRIP_SUMMARY.format("trips"))
def _(t):
    folder = store_trips(t, "yellow_tripdata_2024-01.parquet")
    return trip_summary(scan_trips_month(t.spark, folder, 2024, 1))


@check("scan_trips_range", TRIP_SUMMARY.format("trips"))
def _(t):
    folder = t.folder("raw")
    first = F.col("tpep_pickup_datetime") < F.expr("TIMESTAMP_NTZ '2024-01-16'")
    for month, part in ((1, first), (2, ~first)):
        t.trips.where(part).write.parquet(f"{folder}/yellow_tripdata_2024-0{month}.parquet")
    return trip_summary(scan_trips_range(t.spark, folder, 2024))


@check("scan_trips_month_predicate", TRIP_SUMMARY.format("in_window"))
def _(t):
    folder = store_trips(t, "all")
    return trip_summary(scan_trips(t.spark, f"{folder}/all", year=2024, month=1))


@check("scan_zone_lookup", "SELECT * FROM zones")
def _(t):
    path = t.folder("zones")
    t.zones.coalesce(1).write.csv(path, header=True)
    return scan_zone_lookup(t.spark, path)


@check("scan_parquet", TRIP_SUMMARY.format("trips"))
def _(t):
    return trip_summary(scan_parquet(t.spark, f"{store_trips(t, 'all')}/all"))


@check(
    "schema_contract",
    """SELECT column_name, CASE WHEN column_name IN ('passenger_count', 'RatecodeID',
    'store_and_fwd_flag', 'extra', 'mta_tax', 'improvement_surcharge') THEN 'optional'
    ELSE 'required' END AS role, lower(CASE column_type WHEN 'INTEGER' THEN 'INT'
    WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE column_type END)
    AS found_type, 'ok' AS status FROM (DESCRIBE SELECT * FROM trips)""",
)
def _(t):
    return contract_report(t.trips)


@check("app_zones", 'SELECT "LocationID", "Borough", "Zone", service_zone FROM zones')
def _(t):
    return app_zones(t.zones)


@check("list_zones", 'SELECT "LocationID", "Borough", "Zone", service_zone FROM zones')
def _(t):
    return list_zones(t.dim_zone)


@check(
    "zones_of_borough",
    """SELECT "LocationID", "Borough", "Zone", service_zone FROM zones
    WHERE "Borough" = 'AMERICA' AND "Zone" IS NOT NULL""",
)
def _(t):
    return zones_of_borough(t.dim_zone, "AMERICA")


@check("boroughs", 'SELECT DISTINCT "Borough" AS borough FROM zones WHERE "Borough" IS NOT NULL')
def _(t):
    return boroughs(t.dim_zone)


@check("filter_time_window", TRIP_SUMMARY.format("in_window"))
def _(t):
    return trip_summary(t.in_window)


@check(
    "filter_chronological",
    TRIP_SUMMARY.format("(SELECT * FROM trips WHERE tpep_dropoff_datetime >= tpep_pickup_datetime)"),
)
def _(t):
    return trip_summary(c.filter_chronological(t.trips))


@check("clean_trips", "SELECT * FROM clean")
def _(t):
    return t.clean


@check("clean_trips_shuffled", "SELECT * FROM clean")
def _(t):
    return c.clean_trips(t.trips, START, END, filter_words=0)


@check("anti_join_corrections", TRIP_SUMMARY.format("clean"))
def _(t):
    return trip_summary(c.drop_reversals(t.timed))


@check("correction_groups", "SELECT * FROM corrections")
def _(t):
    return c.correction_groups(t.timed)


@check(
    "correction_summary",
    """SELECT COUNT(*) AS groups, CAST(SUM(records - 1) AS BIGINT) AS extra_records
    FROM corrections""",
)
def _(t):
    return c.correction_summary(t.timed)


@check("business_predicate", f"SELECT {KEY}, payment_type, fare_amount, total_amount FROM standard")
def _(t):
    return b.business_predicate(t.clean).select(
        "VendorID",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "PULocationID",
        "DOLocationID",
        "trip_distance",
        "payment_type",
        "fare_amount",
        "total_amount",
    )


RATIOS = """"PULocationID", tpep_pickup_datetime, fare_amount,
    ROUND(duration_minutes, 6) AS duration_minutes, ROUND(fare_per_mile, 6) AS fare_per_mile,
    ROUND(speed_mph, 6) AS speed_mph"""


def ratios(rows, *more: str):
    rounded = [F.round(c_, 6).alias(c_) for c_ in ("duration_minutes", "fare_per_mile", "speed_mph")]
    return rows.select("PULocationID", "tpep_pickup_datetime", "fare_amount", *rounded, *more)


@check("derive_trip_metrics", f"SELECT {RATIOS} FROM standard")
def _(t):
    return ratios(b.trip_metrics(b.business_predicate(t.clean)))


@check("filter_outliers_null_ok", f"SELECT {RATIOS} FROM business")
def _(t):
    return ratios(b.filter_outliers(t.standard))


CALENDAR = "pickup_date, pickup_year, pickup_month, pickup_hour, weekday_number"


@check("trip_calendar_columns", f"SELECT tpep_pickup_datetime, {CALENDAR} FROM business")
def _(t):
    kept = b.filter_outliers(t.standard)
    return b.trip_calendar(kept).select("tpep_pickup_datetime", *CALENDAR.split(", "))


@check("business_trips", f"SELECT {RATIOS}, payment_type, {CALENDAR} FROM business")
def _(t):
    return ratios(b.business_trips(t.trips, START, END), "payment_type", *CALENDAR.split(", "))


@check("project_demand_fields", f"SELECT {KEY}, fare_amount, total_amount FROM trips")
def _(t):
    return c.demand_fields(t.trips).select(*DEMAND_COLUMNS)


@check(
    "all_null_group",
    """SELECT "VendorID", tpep_pickup_datetime, "PULocationID", "DOLocationID", payment_type,
    fare_amount, total_amount FROM trips WHERE passenger_count IS NULL AND "RatecodeID" IS NULL
    AND store_and_fwd_flag IS NULL AND congestion_surcharge IS NULL AND "Airport_fee" IS NULL""",
)
def _(t):
    return p.all_null_group(t.trips).select(
        "VendorID",
        "tpep_pickup_datetime",
        "PULocationID",
        "DOLocationID",
        "payment_type",
        "fare_amount",
        "total_amount",
    )


for _by in ("VendorID", "payment_type"):

    @check(
        f"all_null_group_by_{_by.lower()}",
        f"""SELECT "{_by}", COUNT(*) AS trip_count FROM trips WHERE passenger_count IS NULL
        AND "RatecodeID" IS NULL AND store_and_fwd_flag IS NULL AND congestion_surcharge IS NULL
        AND "Airport_fee" IS NULL GROUP BY 1""",
    )
    def _(t, by=_by):
        return p.all_null_counts(t.trips, by)


@check(
    "optional_date_filter",
    """SELECT * FROM fact_demand WHERE pickup_date >= DATE '2024-01-05'
    AND pickup_date <= DATE '2024-01-20'""",
)
def _(t):
    return optional_dates(t.fact_demand, "pickup_date", date(2024, 1, 5), date(2024, 1, 20))


EXTREME = """SELECT tpep_pickup_datetime, tpep_dropoff_datetime, "PULocationID", "DOLocationID",
    trip_distance, ROUND(duration_minutes, 6) AS duration_minutes, ROUND(speed_mph, 6) AS speed_mph,
    fare_amount, ROUND(fare_per_mile, 6) AS fare_per_mile, total_amount, "RatecodeID", payment_type
    FROM standard WHERE {0}"""


@check("extreme_records", EXTREME.format("fare_amount > 315"))
def _(t):
    return _rounded(p.extreme_records(t.standard, "fare_amount", 315))


@check("extreme_records_distance", EXTREME.format("trip_distance > 20"))
def _(t):
    return _rounded(p.extreme_records(t.standard, "trip_distance", 20))


def _rounded(rows):
    names = ("duration_minutes", "speed_mph", "fare_per_mile")
    return rows.withColumns({n: F.round(n, 6) for n in names})


@check("sort_keys", f"SELECT {KEY}, fare_amount FROM business")
def _(t):
    keys = KEY.replace('"', "").split(", ")
    return t.business.select(*keys, "fare_amount").orderBy(F.desc("fare_amount"), *keys)


@check("distinct_rows", "SELECT DISTINCT * FROM trips")
def _(t):
    return t.trips.distinct()


@check("dedupe_by_key", 'SELECT DISTINCT "LocationID" FROM hourly')
def _(t):
    return dedupe_by_key(t.hourly, ["LocationID"]).select("LocationID")


SAMPLED = ", ".join(MONEY_COLUMNS)
SAMPLED_TEXT = " || '|' || ".join(f"coalesce(CAST(CAST(ROUND({c} * 10000) AS BIGINT) AS VARCHAR), '-')" for c in MONEY_COLUMNS)


@check(
    "sample_fraction",
    f"""SELECT {SAMPLED} FROM (SELECT {SAMPLED}, row_number() OVER (PARTITION BY {SAMPLED}) AS copy FROM business)
    WHERE substr(sha256('42|' || CAST(copy AS VARCHAR) || '|' || {SAMPLED_TEXT}), 1, 15) < '{threshold(0.01)}'""",
)
def _(t):
    return p.sample_fraction(t.business)


def upsert_sides(t):
    day = F.col("pickup_date")
    old = t.fact_demand.where(day < F.lit("2024-01-20").cast("date"))
    new = t.fact_demand.where(day >= F.lit("2024-01-10").cast("date"))
    target = old.withColumn("capacity", F.col("demand") * 2)
    updates = new.withColumns({"demand": F.col("demand") + 1, "capacity": F.lit(-1).cast("bigint")})
    return target, updates


UPSERT_KEY = ["location_id", "pickup_date", "hour"]


def upsert_sql(demand: str, capacity: str) -> str:
    return f"""SELECT location_id, pickup_date, hour, COALESCE({demand}) AS demand,
    CAST(COALESCE({capacity}) AS BIGINT) AS capacity
    FROM (SELECT location_id, pickup_date, hour, demand, demand * 2 AS capacity
          FROM fact_demand WHERE pickup_date < DATE '2024-01-20') AS o
    FULL JOIN (SELECT location_id, pickup_date, hour, demand + 1 AS demand, -1 AS capacity
          FROM fact_demand WHERE pickup_date >= DATE '2024-01-10') AS n
    USING (location_id, pickup_date, hour)"""


@check("upsert_by_key", upsert_sql("n.demand, o.demand", "n.capacity, o.capacity"))
def _(t):
    return upsert_by_key(*upsert_sides(t), UPSERT_KEY)


@check("upsert_some_columns", upsert_sql("n.demand, o.demand", "o.capacity, n.capacity"))
def _(t):
    return upsert_by_key(*upsert_sides(t), UPSERT_KEY, ["demand"])


@check("insert_if_absent", upsert_sql("o.demand, n.demand", "o.capacity, n.capacity"))
def _(t):
    return upsert_by_key(*upsert_sides(t), UPSERT_KEY, [])

