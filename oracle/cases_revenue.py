"""Revenue, payment, tip and distance questions."""

from __future__ import annotations

from hailgrid.plans import demand_queries as d
from hailgrid.plans import revenue_queries as r
from oracle.registry import check
from oracle.sql import BAND, BAND_ORDER, cents, ratio

TRIPS = "CAST(SUM(trip_count) AS BIGINT)"
N = "CAST(SUM(trip_count) AS DECIMAL(20,0))"


def per_trip(column: str) -> str:
    return ratio(f"SUM({column})", N)


LABELS = 'location_id AS "LocationID", borough AS "Borough", zone AS "Zone"'


@check(
    "business_summary",
    f"""SELECT {TRIPS} AS total_trips, {cents("fare_amount")} AS total_fare_amount,
    {cents("total_amount")} AS total_amount, {cents("tip_amount")} AS total_tip_amount,
    {per_trip("trip_distance")} AS avg_trip_distance FROM fact_trips""",
)
def _(t):
    return r.business_summary(t.fact_trips)


@check(
    "revenue_over_time",
    f"""SELECT pickup_date, {TRIPS} AS total_trips, {cents("fare_amount")} AS fare_amount,
    {cents("total_amount")} AS total_amount, {cents("tip_amount")} AS tip_amount
    FROM fact_trips GROUP BY 1""",
)
def _(t):
    return r.revenue_over_time(t.fact_trips)


REVENUE = f"""SELECT {LABELS}, service_zone, {TRIPS} AS total_trips,
    {cents("fare_amount")} AS fare_amount, {cents("total_amount")} AS total_amount,
    {per_trip("fare_amount")} AS avg_fare_per_trip
    FROM fact_trips JOIN dim_zone USING (location_id)
    GROUP BY location_id, borough, zone, service_zone
    ORDER BY fare_amount DESC, "LocationID" LIMIT 10"""


@check("revenue_by_zone", REVENUE)
def _(t):
    return r.revenue_by_zone(t.fact_trips, t.dim_zone)


SHARE = ratio(f"{N}", "CAST(SUM(SUM(trip_count)) OVER () AS DECIMAL(20,0))", 100)
BREAKDOWN = f"""SELECT payment_type, payment_method, {TRIPS} AS total_trips,
    {cents("fare_amount")} AS fare_amount, {cents("total_amount")} AS total_amount,
    {cents("tip_amount")} AS tip_amount, {SHARE} AS trip_share_pct
    FROM fact_trips JOIN dim_payment USING (payment_type) GROUP BY 1, 2"""


@check("payment_breakdown", BREAKDOWN)
def _(t):
    return r.payment_breakdown(t.fact_trips, t.dim_payment)


@check(
    "share_of_total",
    f"""SELECT location_id, {TRIPS} AS total_trips, {SHARE} AS trip_share_pct
    FROM fact_trips GROUP BY 1""",
)
def _(t):
    totals = t.fact_trips.groupBy("location_id").agg({"trip_count": "sum"})
    named = totals.withColumnRenamed("sum(trip_count)", "total_trips")
    return d.share_of_total(named, "total_trips", "trip_share_pct")


TIPS = f"""{cents("tip_amount")} AS total_tips, {per_trip("tip_amount")} AS avg_tip_per_trip,
    {ratio("SUM(tip_amount)", "SUM(fare_amount)", 100)} AS tip_to_fare_pct,
    {TRIPS} AS total_credit_card_trips"""


@check("tip_analysis", f"SELECT {TIPS} FROM fact_trips WHERE payment_type = 1")
def _(t):
    return r.tip_analysis(t.fact_trips)


@check(
    "tip_analysis_by_zone",
    f"""SELECT {LABELS}, {TIPS} FROM fact_trips JOIN dim_zone USING (location_id)
    WHERE payment_type = 1 GROUP BY location_id, borough, zone
    ORDER BY total_tips DESC, "LocationID" LIMIT 10""",
)
def _(t):
    return r.tip_analysis_by_zone(t.fact_trips, t.dim_zone)


BANDS = f"""SELECT {BAND} AS distance_band, {BAND_ORDER} AS distance_order,
    CAST(SUM(trip_count) AS BIGINT) AS total_trips, {per_trip("fare_amount")} AS avg_fare_per_trip,
    {per_trip("total_amount")} AS avg_total_per_trip,
    {per_trip("tip_amount")} AS avg_recorded_tip_per_trip FROM {{0}} GROUP BY 1, 2"""


@check("trip_distance_bands", BANDS.format("fact_trips"))
def _(t):
    return r.trip_distance_bands(t.fact_trips)


@check(
    "trip_distance_bands_per_trip",
    BANDS.format(
        """(SELECT trip_distance, 1 AS trip_count, CAST(fare_amount AS DECIMAL(18,2)) AS fare_amount,
        CAST(total_amount AS DECIMAL(18,2)) AS total_amount,
        CAST(tip_amount AS DECIMAL(18,2)) AS tip_amount FROM business)"""
    ),
)
def _(t):
    return r.trip_distance_bands_per_trip(t.business)


@check(
    "airport_zones",
    f"""SELECT "Zone", total_trips, fare_amount, avg_fare_per_trip FROM ({REVENUE})
    WHERE service_zone = 'Airports'""",
)
def _(t):
    return r.airport_zones(t.fact_trips, t.dim_zone)


@check(
    "credit_card_share",
    f"""SELECT ROUND(COALESCE(SUM(trip_share_pct), 0), 2) AS credit_card_share_pct
    FROM ({BREAKDOWN}) WHERE lower(payment_method) LIKE '%credit%'""",
)
def _(t):
    return r.credit_card_share(r.payment_breakdown(t.fact_trips, t.dim_payment))


@check(
    "demand_vs_value",
    f"""SELECT * FROM (SELECT zone AS top_demand_zone, CAST(SUM(demand) AS BIGINT)
      AS top_demand_trips FROM fact_demand JOIN dim_zone USING (location_id)
      GROUP BY location_id, zone ORDER BY 2 DESC, location_id LIMIT 1),
    (SELECT "Zone" AS top_revenue_zone, fare_amount AS top_revenue_fare_amount
      FROM ({REVENUE}) ORDER BY fare_amount DESC, "LocationID" LIMIT 1)""",
)
def _(t):
    return r.demand_vs_value(
        d.top_zones(t.fact_demand, t.dim_zone), r.revenue_by_zone(t.fact_trips, t.dim_zone)
    )
