"""Trips that count as business: payment and amount rules, derived ratios, calendar fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailgrid.fixed import (
    BUSINESS_PAYMENT_TYPES,
    DROPOFF,
    MAX_FARE_PER_MILE,
    MAX_SPEED_MPH,
    PICKUP,
)
from hailgrid.functions.calendar import iso_weekday, seconds_between
from hailgrid.operators.cleaning import FILTER_WORDS, clean_trips


def business_predicate(trips: DataFrame) -> DataFrame:
    """Standard payment types with non-negative fare and total."""
    return trips.where(
        F.col("payment_type").isin(BUSINESS_PAYMENT_TYPES)
        & (F.col("fare_amount") >= 0)
        & (F.col("total_amount") >= 0)
    )


def trip_metrics(trips: DataFrame) -> DataFrame:
    """Duration in minutes, fare per mile and speed; NULL where the denominator is not positive."""
    minutes = seconds_between(PICKUP, DROPOFF) / 60
    miles = F.col("trip_distance")
    return trips.withColumns(
        {
            "duration_minutes": minutes,
            "fare_per_mile": F.when(miles > 0, F.col("fare_amount") / miles),
            "speed_mph": F.when(minutes > 0, miles / (minutes / 60)),
        }
    )


def filter_outliers(trips: DataFrame) -> DataFrame:
    """Drop implausible speeds and fares per mile; an unknown ratio is no reason to drop."""
    return trips.where(
        (F.coalesce("speed_mph", F.lit(0.0)) <= MAX_SPEED_MPH)
        & (F.coalesce("fare_per_mile", F.lit(0.0)) <= MAX_FARE_PER_MILE)
    )


def trip_calendar(trips: DataFrame) -> DataFrame:
    """Pickup date, year, month, hour and Monday-based weekday number."""
    return trips.withColumns(
        {
            "pickup_date": F.to_date(PICKUP),
            "pickup_year": F.year(PICKUP),
            "pickup_month": F.month(PICKUP),
            "pickup_hour": F.hour(PICKUP),
            "weekday_number": iso_weekday(PICKUP),
        }
    )


def business_trips(trips: DataFrame, start, end, filter_words: int = FILTER_WORDS) -> DataFrame:
    """The whole chain from raw trips to business trips."""
    return business_from_clean(clean_trips(trips, start, end, filter_words))


def business_from_clean(cleaned: DataFrame) -> DataFrame:
    return trip_calendar(filter_outliers(trip_metrics(business_predicate(cleaned))))
