"""Demand questions, answered from fact_demand and its dimensions.

Facts are aggregated before they meet a dimension, so a join sees one row per zone, date or
hour. Optional bounds become filters only when they are given. Dates are inclusive.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def optional_dates(
    rows: DataFrame, column: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Rows dated from ``first`` to ``last`` inclusive; a missing bound does not filter."""
    if first is not None and last is not None and first > last:
        raise ValueError("the first date must not lie after the last")
    if first is not None:
        rows = rows.where(F.col(column) >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col(column) <= F.lit(last))
    return rows


def checked_limit(limit: int, at_most: int | None = None) -> int:
    """A limit of 1 at least and, if the caller sets a bound, ``at_most`` at most."""
    if limit < 1 or (at_most is not None and limit > at_most):
        raise ValueError("limit must be at least 1" + ("" if at_most is None else f" and {at_most} at most"))
    return limit


def _zone_labels(zones: DataFrame) -> DataFrame:
    return zones.select(
        F.col("location_id").alias("LocationID"),
        F.col("borough").alias("Borough"),
        F.col("zone").alias("Zone"),
        "service_zone",
    )


def _totals() -> list[Column]:
    return [F.sum("demand").alias("total_demand"), F.count("demand").alias("slots")]


def _mean() -> Column:
    return F.round(F.try_divide(F.sum("total_demand"), F.sum("slots")), 6).alias("avg_demand")


def demand_date_range(facts: DataFrame) -> DataFrame:
    return facts.agg(F.min("pickup_date").alias("min_date"), F.max("pickup_date").alias("max_date"))


def list_zones(zones: DataFrame) -> DataFrame:
    return _zone_labels(zones).orderBy("Borough", "Zone")


def boroughs(zones: DataFrame) -> DataFrame:
    return zones.where("borough IS NOT NULL").select("borough").distinct().orderBy("borough")


def zones_of_borough(zones: DataFrame, borough: str) -> DataFrame:
    inside = _zone_labels(zones).where((F.col("Borough") == borough) & F.col("Zone").isNotNull())
    return inside.orderBy("Zone")


def _one_zone(
    facts: DataFrame, zones: DataFrame, location_id: int, first, last, *by: str
) -> DataFrame:
    """Totals of one zone per ``by``, labelled with the zone's attributes."""
    chosen = F.col("location_id") == location_id
    totals = (
        optional_dates(facts.where(chosen), "pickup_date", first, last)
        .groupBy(F.col("location_id").alias("LocationID"), *by)
        .agg(*_totals())
    )
    return totals.join(_zone_labels(zones.where(chosen)), "LocationID")


LABELS = ["LocationID", "Borough", "Zone", "service_zone"]


def zone_demand_over_time(facts, zones, location_id, first=None, last=None) -> DataFrame:
    """Daily demand of one zone."""
    daily = _one_zone(facts, zones, location_id, first, last, "pickup_date")
    return daily.select(*LABELS, F.col("pickup_date").alias("date"), "total_demand").orderBy("date")


def zone_demand_by_hour(facts, zones, hours, location_id, first=None, last=None) -> DataFrame:
    """Mean and total demand of one zone per hour of the day."""
    hourly = _one_zone(facts, zones, location_id, first, last, "hour")
    return (
        hourly.join(hours.select("hour"), "hour")
        .groupBy(*LABELS, "hour")
        .agg(_mean(), F.sum("total_demand").alias("total_demand"))
        .orderBy("hour")
    )


def zone_demand_by_weekday(facts, zones, dates, location_id, first=None, last=None) -> DataFrame:
    """Mean and total demand of one zone per weekday."""
    daily = _one_zone(facts, zones, location_id, first, last, "pickup_date")
    return _by_weekday(daily, dates, *LABELS)


def _by_weekday(daily: DataFrame, dates: DataFrame, *by: str) -> DataFrame:
    calendar = dates.select(F.col("full_date").alias("pickup_date"), "weekday_number", "weekday")
    return (
        daily.join(calendar, "pickup_date")
        .groupBy(*by, "weekday_number", "weekday")
        .agg(_mean(), F.sum("total_demand").alias("total_demand"))
        .orderBy("weekday_number")
    )


def demand_by_hour(facts: DataFrame, hours: DataFrame) -> DataFrame:
    """Mean and total demand per hour of the day; the mean is over zone-hour rows."""
    hourly = facts.groupBy("hour").agg(*_totals())
    return (
        hourly.join(hours.select("hour"), "hour")
        .groupBy("hour")
        .agg(_mean(), F.sum("total_demand").alias("total_demand"))
        .orderBy("hour")
    )


def demand_by_weekday(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Mean and total demand per weekday; the mean is over zone-hour rows."""
    return _by_weekday(facts.groupBy("pickup_date").agg(*_totals()), dates)


def demand_over_time(facts: DataFrame, first=None, last=None) -> DataFrame:
    """Daily demand of all zones. The bounds act on the facts, before they are aggregated."""
    return (
        optional_dates(facts, "pickup_date", first, last)
        .groupBy(F.col("pickup_date").alias("pickup_hour"))
        .agg(F.sum("demand").alias("total_demand"))
        .orderBy("pickup_hour")
    )


def top_zones(facts: DataFrame, zones: DataFrame, limit: int = 10, at_most: int | None = None) -> DataFrame:
    """Zones by total demand, with mean hourly demand."""
    totals = facts.groupBy(F.col("location_id").alias("LocationID")).agg(
        F.round(F.avg("demand"), 6).alias("avg_hourly_demand"),
        F.sum("demand").alias("total_demand"),
    )
    return (
        totals.join(_zone_labels(zones), "LocationID")
        .select(*LABELS, "avg_hourly_demand", "total_demand")
        .orderBy(F.desc("total_demand"), "LocationID")
        .limit(checked_limit(limit, at_most))
    )


# --- Dashboard figures ------------------------------------------------------------------


def daily_resample(daily: DataFrame) -> DataFrame:
    """Daily totals without gaps: days between the first and the last get zero."""
    ends = daily.agg(F.min("pickup_hour").alias("first"), F.max("pickup_hour").alias("last"))
    days = ends.where("first IS NOT NULL").select(
        F.explode(F.expr("sequence(first, last, INTERVAL 1 DAY)")).alias("pickup_hour")
    )
    totals = daily.groupBy("pickup_hour").agg(F.sum("total_demand").alias("total_demand"))
    return days.join(totals, "pickup_hour", "left").fillna(0, ["total_demand"]).orderBy("pickup_hour")


def zone_kpis(facts, location_id: int, first=None, last=None) -> DataFrame:
    """Total, mean daily demand, and the peak day of one zone (the earliest on a tie)."""
    daily = (
        optional_dates(facts.where(F.col("location_id") == location_id), "pickup_date", first, last)
        .groupBy("pickup_date")
        .agg(F.sum("demand").alias("demand"))
    )
    peak = F.max_by(
        F.struct("demand", "pickup_date"), F.struct("demand", -F.unix_date("pickup_date"))
    )
    return daily.agg(
        F.sum("demand").alias("total_demand"),
        F.round(F.avg("demand"), 6).alias("avg_daily_demand"),
        peak.alias("peak"),
    ).select(
        "total_demand",
        "avg_daily_demand",
        F.col("peak.demand").alias("peak_daily_demand"),
        F.col("peak.pickup_date").alias("peak_date"),
    )


def demand_insights(by_hour: DataFrame, by_weekday: DataFrame) -> DataFrame:
    """Peak hour, lowest hour, strongest weekday, and the peak against the mean hour in percent.

    Ties go to the earlier hour or weekday. Inputs are the 24 hourly and 7 weekday means.
    """
    hour, mean = F.col("hour"), F.col("avg_demand")
    hours = by_hour.agg(
        F.max_by("hour", F.struct(mean, -hour)).alias("peak_hour"),
        F.max("avg_demand").alias("peak_hour_demand"),
        F.min_by("hour", F.struct(mean, hour)).alias("low_hour"),
        F.min("avg_demand").alias("low_hour_demand"),
        F.avg("avg_demand").alias("mean_hour_demand"),
    )
    number = F.col("weekday_number")
    strongest = by_weekday.agg(F.max_by("weekday", F.struct(mean, -number)).alias("day")).scalar()
    strongest_mean = by_weekday.agg(F.max("avg_demand")).scalar()
    excess = (F.try_divide(F.col("peak_hour_demand"), F.col("mean_hour_demand")) - 1) * 100
    return hours.select(
        "peak_hour",
        "peak_hour_demand",
        "low_hour",
        "low_hour_demand",
        strongest.alias("peak_weekday"),
        strongest_mean.alias("peak_weekday_demand"),
        F.round(excess, 4).alias("peak_vs_average_pct"),
    )


def first_ranked(rows: DataFrame, *order) -> DataFrame:
    """The single first row of a small result in the given order."""
    return rows.orderBy(*order).limit(1)


def share_of_total(rows: DataFrame, column: str, share: str) -> DataFrame:
    """Adds each row's percentage of the column total.

    ``rows`` is an aggregate with a few rows (one per payment type, say).
    """
    total = F.sum(column).over(Window.partitionBy())
    return rows.withColumn(
        share,
        F.round(
            F.try_divide(
                F.col(column).cast("decimal(20,0)") * F.lit(100), total.cast("decimal(20,0)")
            ),
            2,
        ).cast("double"),
    )
