"""Star schema: dimensions, demand facts, revenue facts, and their integrity audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hailgrid.fixed import FACT_MEASURES, PAYMENT_METHODS
from hailgrid.functions.calendar import day_part, iso_weekday, weekday_name
from hailgrid.functions.money import MONEY, exact_sum

FACT_DEMAND_KEY = ["location_id", "pickup_date", "hour"]
FACT_TRIPS_KEY = [*FACT_DEMAND_KEY, "payment_type"]


def first_per_key(rows: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """One row per key, the first in the given order.

    The earliest row is found with ``min_by``-style aggregation on a struct, so copies of a hot
    key are reduced before the shuffle instead of being sorted in one window partition.
    """
    rest = [name for name in rows.columns if name not in keys]
    rank = F.struct(*order, *rest) if order else F.struct(*rest)
    picked = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("picked"))
    return picked.select(*keys, "picked.*").select(*rows.columns)


def dim_zone(zones: DataFrame) -> DataFrame:
    renamed = zones.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        "service_zone",
    )
    return first_per_key(renamed, ["location_id"]).orderBy("location_id")


def dim_date(dates: DataFrame, column: str = "date") -> DataFrame:
    """Calendar attributes of every distinct date."""
    day = F.col("full_date")
    return (
        dates.select(F.to_date(column).alias("full_date"))
        .distinct()
        .select(
            "full_date",
            F.year(day).cast("smallint").alias("year"),
            F.month(day).cast("smallint").alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.dayofmonth(day).cast("smallint").alias("day"),
            iso_weekday("full_date").cast("smallint").alias("weekday_number"),
            weekday_name("full_date").alias("weekday"),
            (iso_weekday("full_date") >= 6).alias("is_weekend"),
        )
        .orderBy("full_date")
    )


def dim_hour(spark: SparkSession) -> DataFrame:
    hours = spark.range(24).select(F.col("id").cast("smallint").alias("hour"))
    return hours.withColumn("day_part", day_part(F.col("hour")))


def dim_payment(spark: SparkSession) -> DataFrame:
    methods = ", ".join(f"({code}S, '{name}')" for code, name in PAYMENT_METHODS)
    return spark.sql(f"SELECT * FROM VALUES {methods} AS t(payment_type, payment_method)")


def fact_demand(daily: DataFrame) -> DataFrame:
    """Demand facts from the zone-hour-day table."""
    return daily.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("date").alias("pickup_date"),
        F.col("hour").cast("smallint").alias("hour"),
        F.col("demand").cast("bigint").alias("demand"),
    )


def fact_trips(business: DataFrame) -> DataFrame:
    """Trip count and eight sums per zone, date, hour and payment type.

    Sums run on exact units, so they are the same however the trips are partitioned. Counts
    stay BIGINT and sums DECIMAL(18,2): one busy slot must not overflow.
    """
    return (
        business.groupBy("PULocationID", "pickup_date", "pickup_hour", "payment_type")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            *[exact_sum(column).alias(name) for name, column in FACT_MEASURES],
        )
        .select(
            F.col("PULocationID").cast("int").alias("location_id"),
            "pickup_date",
            F.col("pickup_hour").cast("smallint").alias("hour"),
            F.col("payment_type").cast("smallint").alias("payment_type"),
            "trip_count",
            *[F.round(name, 2).cast(MONEY).alias(name) for name, _ in FACT_MEASURES],
        )
    )


def validate_fact_trips(facts: DataFrame) -> DataFrame:
    """Row count, trips, and the ranges of date and hour."""
    return facts.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.sum("trip_count").alias("total_trips"),
        F.min("pickup_date").alias("min_date"),
        F.max("pickup_date").alias("max_date"),
        F.min("hour").alias("min_hour"),
        F.max("hour").alias("max_hour"),
    )


def duplicate_keys(table: DataFrame, keys: list[str], label: str) -> DataFrame:
    """How many rows repeat a primary key."""
    return (
        table.groupBy(*keys)
        .count()
        .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations"))
        .select(F.lit(label).alias("rule"), "violations")
    )


def orphans(table: DataFrame, column: str, parent: DataFrame, parent_key: str, label: str) -> DataFrame:
    """How many rows refer to a parent that does not exist.

    The references are counted per value first, so the join sees one row per value.
    """
    references = table.where(F.col(column).isNotNull()).groupBy(column).count()
    parents = parent.select(F.col(parent_key).alias(column)).distinct()
    return references.join(parents, column, "left_anti").agg(
        F.lit(label).alias("rule"), F.coalesce(F.sum("count"), F.lit(0)).alias("violations")
    )


def broken(table: DataFrame, **rules: Column) -> DataFrame:
    """How many rows contradict each rule; all rules of a table are checked in one pass."""
    counts = table.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def star_constraints(
    zones: DataFrame,
    dates: DataFrame,
    hours: DataFrame,
    payments: DataFrame,
    demand: DataFrame,
    trips: DataFrame,
) -> DataFrame:
    """Primary keys, references and value ranges of the star tables, as violation counts."""
    audits = [
        duplicate_keys(zones, ["location_id"], "pk_dim_zone"),
        duplicate_keys(dates, ["full_date"], "pk_dim_date"),
        duplicate_keys(hours, ["hour"], "pk_dim_hour"),
        duplicate_keys(payments, ["payment_type"], "pk_dim_payment"),
        duplicate_keys(demand, FACT_DEMAND_KEY, "pk_fact_demand"),
        duplicate_keys(trips, FACT_TRIPS_KEY, "pk_fact_trips"),
        orphans(demand, "location_id", zones, "location_id", "fk_demand_zone"),
        orphans(demand, "pickup_date", dates, "full_date", "fk_demand_date"),
        orphans(demand, "hour", hours, "hour", "fk_demand_hour"),
        orphans(trips, "location_id", zones, "location_id", "fk_trips_zone"),
        orphans(trips, "pickup_date", dates, "full_date", "fk_trips_date"),
        orphans(trips, "hour", hours, "hour", "fk_trips_hour"),
        orphans(trips, "payment_type", payments, "payment_type", "fk_trips_payment"),
        broken(
            dates,
            check_month=F.col("month").between(1, 12),
            check_weekday=F.col("weekday_number").between(1, 7),
        ),
        broken(hours, check_hour=F.col("hour").between(0, 23)),
        broken(demand, check_demand=F.col("demand") >= 0),
    ]
    report = audits[0]
    for audit in audits[1:]:
        report = report.unionByName(audit)
    return report


def join_fact_zone(facts: DataFrame, zones: DataFrame) -> DataFrame:
    return facts.join(zones, "location_id")


def join_fact_payment(facts: DataFrame, payments: DataFrame) -> DataFrame:
    return facts.join(payments, "payment_type")


def join_fact_hour(facts: DataFrame, hours: DataFrame) -> DataFrame:
    return facts.join(hours, "hour")


def join_fact_date(facts: DataFrame, dates: DataFrame) -> DataFrame:
    return facts.join(dates, facts["pickup_date"] == dates["full_date"]).drop("full_date")

