"""Revenue, payment, tip and distance questions, answered from fact_trips.

Facts are aggregated before they meet a dimension. Money is summed as decimals; ratios are
rounded to two digits and are NULL when the denominator is zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailgrid.fixed import AIRPORT_SERVICE_ZONE, CREDIT_CARD, DISTANCE_BANDS
from hailgrid.functions.money import exact_sum, ratio
from hailgrid.plans.demand_queries import LABELS, checked_limit, first_ranked, share_of_total


def _amount(column: str, name: str | None = None) -> Column:
    return F.round(F.sum(column), 2).cast("double").alias(name or column)


def _trips(name: str = "total_trips") -> Column:
    return F.sum("trip_count").alias(name)


def _per_trip(column: str, name: str) -> Column:
    return ratio(F.sum(column), F.sum("trip_count")).alias(name)


def _tip_columns() -> list[Column]:
    return [
        _amount("tip_amount", "total_tips"),
        _per_trip("tip_amount", "avg_tip_per_trip"),
        ratio(F.sum("tip_amount"), F.sum("fare_amount"), 100).alias("tip_to_fare_pct"),
        _trips("total_credit_card_trips"),
    ]


def _labelled(totals: DataFrame, zones: DataFrame) -> DataFrame:
    labels = zones.select(
        F.col("location_id"),
        F.col("borough").alias("Borough"),
        F.col("zone").alias("Zone"),
        "service_zone",
    )
    return totals.join(labels, "location_id").withColumnRenamed("location_id", "LocationID")


def business_summary(facts: DataFrame) -> DataFrame:
    """Trips, fares, collected amount, tips and mean distance per trip."""
    return facts.agg(
        _trips(),
        _amount("fare_amount", "total_fare_amount"),
        _amount("total_amount"),
        _amount("tip_amount", "total_tip_amount"),
        _per_trip("trip_distance", "avg_trip_distance"),
    )


def revenue_over_time(facts: DataFrame) -> DataFrame:
    """Trips, fares, totals and tips per pickup date."""
    return (
        facts.groupBy("pickup_date")
        .agg(_trips(), _amount("fare_amount"), _amount("total_amount"), _amount("tip_amount"))
        .orderBy("pickup_date")
    )


def revenue_by_zone(facts: DataFrame, zones: DataFrame, limit: int = 10, at_most: int | None = None) -> DataFrame:
    """Pickup zones by fare revenue."""
    totals = facts.groupBy("location_id").agg(
        _trips(),
        _amount("fare_amount"),
        _amount("total_amount"),
        _per_trip("fare_amount", "avg_fare_per_trip"),
    )
    return (
        _labelled(totals, zones)
        .select(*LABELS, "total_trips", "fare_amount", "total_amount", "avg_fare_per_trip")
        .orderBy(F.desc("fare_amount"), "LocationID")
        .limit(checked_limit(limit, at_most))
    )


def payment_breakdown(facts: DataFrame, payments: DataFrame) -> DataFrame:
    """Trips, money and share of trips per payment method."""
    totals = facts.groupBy("payment_type").agg(
        _trips(), _amount("fare_amount"), _amount("total_amount"), _amount("tip_amount")
    )
    known = totals.join(payments, "payment_type")
    return share_of_total(known, "total_trips", "trip_share_pct").orderBy(
        F.desc("total_trips"), "payment_type"
    )


def tip_analysis(facts: DataFrame) -> DataFrame:
    """Recorded tips of credit-card trips."""
    return facts.where(F.col("payment_type") == CREDIT_CARD).agg(*_tip_columns())


def tip_analysis_by_zone(facts: DataFrame, zones: DataFrame, limit: int = 10, at_most: int | None = None) -> DataFrame:
    """Pickup zones by recorded credit-card tips."""
    totals = (
        facts.where(F.col("payment_type") == CREDIT_CARD).groupBy("location_id").agg(*_tip_columns())
    )
    return (
        _labelled(totals, zones)
        .drop("service_zone")
        .orderBy(F.desc("total_tips"), "LocationID")
        .limit(checked_limit(limit, at_most))
    )


def distance_band(distance: Column) -> tuple[Column, Column]:
    """Label and order of the band a distance falls into."""
    _, last_order, last_label = DISTANCE_BANDS[-1]
    label, order = F.lit(last_label), F.lit(last_order)
    for upper, position, name in reversed(DISTANCE_BANDS[:-1]):
        label = F.when(distance < upper, name).otherwise(label)
        order = F.when(distance < upper, position).otherwise(order)
    return label.alias("distance_band"), order.alias("distance_order")


def trip_distance_bands(facts: DataFrame) -> DataFrame:
    """Mean amounts per trip by distance band; a fact row is banded by its summed distance."""
    label, order = distance_band(F.col("trip_distance"))
    return _band_figures(facts.select("*", label, order))


def trip_distance_bands_per_trip(business: DataFrame) -> DataFrame:
    """The same figures with every trip banded by its own distance."""
    sums = [exact_sum(c).alias(c) for c in ("fare_amount", "total_amount", "tip_amount")]
    trips = F.count(F.lit(1)).alias("trip_count")
    return _band_figures(business.groupBy(*distance_band(F.col("trip_distance"))).agg(trips, *sums))


def _band_figures(banded: DataFrame) -> DataFrame:
    return (
        banded.groupBy("distance_band", "distance_order")
        .agg(
            _trips(),
            _per_trip("fare_amount", "avg_fare_per_trip"),
            _per_trip("total_amount", "avg_total_per_trip"),
            _per_trip("tip_amount", "avg_recorded_tip_per_trip"),
        )
        .orderBy("distance_order")
    )


def airport_zones(facts: DataFrame, zones: DataFrame, limit: int = 10, at_most: int | None = None) -> DataFrame:
    """The airports among the top revenue zones."""
    top = revenue_by_zone(facts, zones, limit)
    return top.where(F.col("service_zone") == AIRPORT_SERVICE_ZONE).select(
        "Zone", "total_trips", "fare_amount", "avg_fare_per_trip"
    )


def credit_card_share(breakdown: DataFrame) -> DataFrame:
    """Summed trip share of the methods whose name contains "credit" in any case."""
    is_credit = F.lower("payment_method").contains("credit")
    return breakdown.where(is_credit).agg(
        F.round(F.coalesce(F.sum("trip_share_pct"), F.lit(0.0)), 2).alias("credit_card_share_pct")
    )


def demand_vs_value(demand_ranking: DataFrame, revenue_ranking: DataFrame) -> DataFrame:
    """The zone with the most pickups next to the zone with the most fare revenue."""
    busiest = first_ranked(demand_ranking, F.desc("total_demand"), "LocationID").select(
        F.lit("top").alias("rank"),
        F.col("Zone").alias("top_demand_zone"),
        F.col("total_demand").alias("top_demand_trips"),
    )
    richest = first_ranked(revenue_ranking, F.desc("fare_amount"), "LocationID").select(
        F.lit("top").alias("rank"),
        F.col("Zone").alias("top_revenue_zone"),
        F.col("fare_amount").alias("top_revenue_fare_amount"),
    )
    return busiest.join(richest, "rank", "full_outer").drop("rank")
