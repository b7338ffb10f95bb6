"""Mean-demand profiles: strictly historical ones for backtests, full ones for scoring.

All grains are derived from the finest partial sums (zone, weekday, hour, and month where it
matters). The trips' demand is therefore aggregated once, and every wider mean is a window
over a table with at most 168 rows per zone and month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hailgrid.fixed import FUTURE_FEATURES
from hailgrid.functions.calendar import with_cycles, with_future_calendar

SLOT_KEYS = ["LocationID", "day_of_week", "hour"]
MONTH_SLOT_KEYS = ["calendar_month", *SLOT_KEYS]
# Grain of each profile column, widest first.
GRAINS = {
    "zone_mean_demand": ["LocationID"],
    "zone_hour_mean": ["LocationID", "hour"],
    "zone_dow_hour_mean": ["LocationID", "day_of_week", "hour"],
}


def with_calendar_month(demand: DataFrame) -> DataFrame:
    return with_future_calendar(demand).withColumn("calendar_month", F.trunc("pickup_hour", "month"))


def month_partials(demand: DataFrame) -> DataFrame:
    """Demand sum and observation count per month, zone, weekday and hour."""
    return _partials(with_calendar_month(demand), MONTH_SLOT_KEYS)


def coarser_partials(partials: DataFrame, *keys: str) -> DataFrame:
    """Partials of a wider grain, added up from finer ones."""
    return partials.groupBy(*keys).agg(
        F.sum("demand_sum").alias("demand_sum"),
        F.sum("demand_count").alias("demand_count"),
    )


def _partials(data: DataFrame, keys: list[str]) -> DataFrame:
    return data.groupBy(*keys).agg(
        F.sum("demand").alias("demand_sum"), F.count("demand").alias("demand_count")
    )


def _mean_over(window: Window) -> Column:
    return F.try_divide(F.sum("demand_sum").over(window), F.sum("demand_count").over(window))


def expanding_profiles(demand: DataFrame) -> DataFrame:
    """The three means over strictly earlier months, per month, zone, weekday and hour.

    The frame is a range over the month number, so one month's own rows never enter it. All
    three windows are satisfied by one shuffle on the zone.
    """
    month_number = F.year("calendar_month") * 12 + F.month("calendar_month")
    means = {
        name: _mean_over(
            Window.partitionBy(*keys)
            .orderBy("month_number")
            .rangeBetween(Window.unboundedPreceding, -1)
        )
        for name, keys in GRAINS.items()
    }
    return (
        month_partials(demand)
        .withColumn("month_number", month_number)
        .withColumns(means)
        .select(*MONTH_SLOT_KEYS, *GRAINS)
    )


def historical_profile_features(demand: DataFrame) -> DataFrame:
    """Demand rows with calendar features and the profiles known before their month."""
    return with_calendar_month(demand).join(expanding_profiles(demand), MONTH_SLOT_KEYS, "left")


def full_profiles(demand: DataFrame) -> DataFrame:
    """The three means over all history for every observed zone at all 168 weekly hours.

    A weekly hour that was never observed has no mean of its own but still gets the wider ones.
    """
    return profiles_of_partials(_partials(with_future_calendar(demand), SLOT_KEYS))


def profiles_of_partials(observed: DataFrame) -> DataFrame:
    """``full_profiles`` from demand sums and counts per zone, weekday and hour."""
    weekly_hours = (
        observed.select("LocationID")
        .distinct()
        .withColumn("day_of_week", F.explode(F.sequence(F.lit(1), F.lit(7))))
        .withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    )
    means = {name: _mean_over(Window.partitionBy(*keys)) for name, keys in GRAINS.items()}
    return (
        weekly_hours.join(observed, SLOT_KEYS, "left")
        .withColumns(means)
        .select(*SLOT_KEYS, *GRAINS)
    )


def scoring_slots(zones: DataFrame) -> DataFrame:
    """Every zone at every month, weekday and hour."""
    return (
        zones.select("LocationID")
        .distinct()
        .withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
        .withColumn("day_of_week", F.explode(F.sequence(F.lit(1), F.lit(7))))
        .withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    )


def future_scoring_grid(demand: DataFrame) -> DataFrame:
    """Zone, month, weekday and hour with calendar features and full-history profiles."""
    months = F.explode(F.sequence(F.lit(1), F.lit(12)))
    return with_cycles(full_profiles(demand).withColumn("month", months)).select(
        "LocationID", *FUTURE_FEATURES
    )


def dropna_features(rows: DataFrame) -> DataFrame:
    """Rows on which every future-safe feature is known."""
    return rows.dropna(subset=FUTURE_FEATURES)
