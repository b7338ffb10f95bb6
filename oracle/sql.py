"""Common table expressions for DuckDB: the driver's views turned into every derived input."""

from __future__ import annotations

import re

from oracle.inputs import END, LAST_HOUR, MONTHLY_DEMAND, REQUESTS, START, TRIPS, ZONES, duckdb_sql

KEY = (
    '"VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, "PULocationID", "DOLocationID", '
    "trip_distance"
)
MEASURES = {
    "fare_amount": "fare_amount",
    "total_amount": "total_amount",
    "tip_amount": "tip_amount",
    "trip_distance": "trip_distance",
    "tolls_amount": "tolls_amount",
    "congestion_surcharge": "congestion_surcharge",
    "airport_fee": '"Airport_fee"',
    "cbd_congestion_fee": "cbd_congestion_fee",
}
PI2 = "6.283185307179586"


def ntz(text: str) -> str:
    return f"TIMESTAMP '{text}'"


def exact_sum(column: str) -> str:
    return f"SUM(CAST({column} AS DECIMAL(18,6)))"


def exact_mean(column: str) -> str:
    """Mean of exact decimals, as both engines compute it from the same two doubles."""
    return f"ROUND(CAST({exact_sum(column)} AS DOUBLE) / COUNT({column}), 6)"


def ratio(numerator: str, denominator: str, factor: int = 1) -> str:
    """factor * a / b to two digits, half up, in integer arithmetic (a, b >= 0, cents)."""
    num = f"({factor} * CAST({numerator} * 100 AS HUGEINT) * 100)"
    den = f"CAST({denominator} * 100 AS HUGEINT)"
    return f"CAST((2 * {num} + {den}) // NULLIF(2 * {den}, 0) AS DOUBLE) / 100"


def cents(column: str) -> str:
    return f"CAST(ROUND(SUM({column}), 2) AS DOUBLE)"


def calendar(at: str) -> str:
    """hour, Sunday-based weekday, weekend flag and circle positions."""
    return f"""CAST(hour({at}) AS INT) AS hour, CAST(dayofweek({at}) + 1 AS INT) AS day_of_week"""


def cycles(*parts: tuple[str, str, int]) -> str:
    return ", ".join(
        f"ROUND(sin({PI2} * {c} / {n}), 6) + 0 AS {p}_sin, ROUND(cos({PI2} * {c} / {n}), 6) + 0 AS {p}_cos"
        for p, c, n in parts
    )


BAND = """CASE WHEN trip_distance < 2 THEN '0-2 miles' WHEN trip_distance < 5 THEN '2-5 miles'
 WHEN trip_distance < 10 THEN '5-10 miles' WHEN trip_distance < 20 THEN '10-20 miles'
 ELSE '20+ miles' END"""
BAND_ORDER = """CASE WHEN trip_distance < 2 THEN 1 WHEN trip_distance < 5 THEN 2
 WHEN trip_distance < 10 THEN 3 WHEN trip_distance < 20 THEN 4 ELSE 5 END"""

CTES = {
    "trips": duckdb_sql(TRIPS),
    "zones": duckdb_sql(ZONES),
    "monthly_demand": duckdb_sql(MONTHLY_DEMAND),
    "requests": duckdb_sql(REQUESTS),
    "in_window": f"""SELECT * FROM trips WHERE tpep_pickup_datetime >= {ntz(START)}
        AND tpep_pickup_datetime < {ntz(END)}""",
    "timed": "SELECT * FROM in_window WHERE tpep_dropoff_datetime >= tpep_pickup_datetime",
    "corrections": f"""SELECT {KEY}, COUNT(*) AS records, MIN(fare_amount) AS min_fare,
        MAX(fare_amount) AS max_fare FROM timed GROUP BY ALL
        HAVING COUNT(*) > 1 AND MIN(fare_amount) < 0 AND MAX(fare_amount) >= 0""",
    "clean": f"SELECT * FROM timed ANTI JOIN corrections USING ({KEY})",
    "standard": """SELECT *, (epoch(date_trunc('second', tpep_dropoff_datetime))
            - epoch(date_trunc('second', tpep_pickup_datetime))) / 60 AS duration_minutes,
        CASE WHEN trip_distance > 0 THEN fare_amount / trip_distance END AS fare_per_mile,
        CASE WHEN epoch(date_trunc('second', tpep_dropoff_datetime))
            > epoch(date_trunc('second', tpep_pickup_datetime))
        THEN trip_distance / ((epoch(date_trunc('second', tpep_dropoff_datetime))
            - epoch(date_trunc('second', tpep_pickup_datetime))) / 60 / 60) END AS speed_mph
        FROM clean
        WHERE payment_type IN (1, 2, 3, 4, 5) AND fare_amount >= 0 AND total_amount >= 0""",
    "business": """SELECT *, CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
        CAST(year(tpep_pickup_datetime) AS INT) AS pickup_year,
        CAST(month(tpep_pickup_datetime) AS INT) AS pickup_month,
        CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour,
        CAST(isodow(tpep_pickup_datetime) AS INT) AS weekday_number
        FROM standard WHERE (speed_mph IS NULL OR speed_mph <= 100)
        AND (fare_per_mile IS NULL OR fare_per_mile <= 100)""",
    "hourly": """SELECT "PULocationID" AS "LocationID",
        date_trunc('hour', tpep_pickup_datetime) AS pickup_hour, COUNT(*) AS demand
        FROM clean GROUP BY 1, 2""",
    "zone_hours": f"""SELECT "LocationID", h.pickup_hour FROM zones,
        (SELECT unnest(generate_series({ntz(START)}, {ntz(LAST_HOUR)}, INTERVAL 1 HOUR))
         AS pickup_hour) AS h""",
    "grid": """SELECT "LocationID", pickup_hour, COALESCE(demand, 0) AS demand
        FROM zone_hours LEFT JOIN hourly USING ("LocationID", pickup_hour)""",
    "timed_features": f"""SELECT *, CASE WHEN day_of_week IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
        {cycles(("hour", "hour", 24), ("dow", "day_of_week", 7))} FROM (
        SELECT *, {calendar("pickup_hour")}, CAST(day(pickup_hour) AS INT) AS day_of_month
        FROM grid)""",
    "features": """SELECT *, LAG(demand, 1) OVER w AS lag_1h, LAG(demand, 24) OVER w AS lag_24h,
        LAG(demand, 168) OVER w AS lag_168h,
        ROUND(AVG(demand) OVER d, 6) AS rolling_mean_24h, COUNT(demand) OVER d AS history_count_24h,
        ROUND(AVG(demand) OVER k, 6) AS rolling_mean_168h,
        COUNT(demand) OVER k AS history_count_168h
        FROM timed_features
        WINDOW w AS (PARTITION BY "LocationID" ORDER BY pickup_hour),
        d AS (PARTITION BY "LocationID" ORDER BY pickup_hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING),
        k AS (PARTITION BY "LocationID" ORDER BY pickup_hour ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING)
        """,
    "model_rows": """SELECT * REPLACE (CAST(demand AS DOUBLE) AS demand) FROM features
        WHERE history_count_168h = 168""",
    "daily": """SELECT "LocationID", "Borough", "Zone", service_zone,
        CAST(pickup_hour AS DATE) AS date, CAST(hour(pickup_hour) AS INT) AS hour,
        CAST(isodow(pickup_hour) AS INT) AS weekday_number, dayname(pickup_hour) AS weekday, demand
        FROM grid LEFT JOIN zones USING ("LocationID")""",
    "dim_zone": """SELECT CAST("LocationID" AS INT) AS location_id, "Borough" AS borough,
        "Zone" AS zone, service_zone FROM zones
        QUALIFY row_number() OVER (PARTITION BY "LocationID" ORDER BY "Borough", "Zone", service_zone) = 1""",
    "dim_date": """SELECT DISTINCT date AS full_date, CAST(year(date) AS SMALLINT) AS year,
        CAST(month(date) AS SMALLINT) AS month, monthname(date) AS month_name,
        CAST(day(date) AS SMALLINT) AS day, CAST(isodow(date) AS SMALLINT) AS weekday_number,
        dayname(date) AS weekday, isodow(date) IN (6, 7) AS is_weekend FROM daily""",
    "dim_hour": """SELECT CAST(h AS SMALLINT) AS hour, CASE WHEN h <= 5 THEN 'Night'
        WHEN h <= 11 THEN 'Morning' WHEN h <= 17 THEN 'Afternoon' ELSE 'Evening' END AS day_part
        FROM range(24) AS r(h)""",
    "dim_payment": """SELECT CAST(c AS SMALLINT) AS payment_type, m AS payment_method
        FROM (VALUES (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'),
        (5, 'Unknown'), (6, 'Voided trip')) AS v(c, m)""",
    "fact_demand": """SELECT CAST("LocationID" AS INT) AS location_id, date AS pickup_date,
        CAST(hour AS SMALLINT) AS hour, CAST(demand AS BIGINT) AS demand FROM daily""",
    "fact_trips": f"""SELECT CAST("PULocationID" AS INT) AS location_id, pickup_date,
        CAST(pickup_hour AS SMALLINT) AS hour, CAST(payment_type AS SMALLINT) AS payment_type,
        COUNT(*) AS trip_count,
        {", ".join(f"CAST(ROUND({exact_sum(c)}, 2) AS DECIMAL(18,2)) AS {n}" for n, c in MEASURES.items())}
        FROM business GROUP BY 1, 2, 3, 4""",
    "profiled": f"""SELECT *, CAST(date_trunc('month', pickup_hour) AS DATE) AS calendar_month,
        {calendar("pickup_hour")}, CAST(month(pickup_hour) AS INT) AS month FROM monthly_demand""",
    "partials": """SELECT calendar_month, "LocationID", day_of_week, hour,
        CAST(SUM(demand) AS BIGINT) AS demand_sum, COUNT(demand) AS demand_count
        FROM profiled GROUP BY ALL""",
    "zone_months": """SELECT calendar_month, "LocationID",
        SUM(SUM(demand)) OVER w / SUM(COUNT(*)) OVER w AS zone_mean_demand
        FROM profiled GROUP BY calendar_month, "LocationID"
        WINDOW w AS (PARTITION BY "LocationID" ORDER BY calendar_month
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "hour_months": """SELECT calendar_month, "LocationID", hour,
        SUM(SUM(demand)) OVER w / SUM(COUNT(*)) OVER w AS zone_hour_mean
        FROM profiled GROUP BY calendar_month, "LocationID", hour
        WINDOW w AS (PARTITION BY "LocationID", hour ORDER BY calendar_month
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "dow_hour_months": """SELECT calendar_month, "LocationID", day_of_week, hour,
        SUM(SUM(demand)) OVER w / SUM(COUNT(*)) OVER w AS zone_dow_hour_mean
        FROM profiled GROUP BY calendar_month, "LocationID", day_of_week, hour
        WINDOW w AS (PARTITION BY "LocationID", day_of_week, hour ORDER BY calendar_month
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "expanding_exact": """SELECT calendar_month, "LocationID", day_of_week, hour,
        zone_mean_demand, zone_hour_mean, zone_dow_hour_mean
        FROM dow_hour_months JOIN zone_months USING (calendar_month, "LocationID")
        JOIN hour_months USING (calendar_month, "LocationID", hour)""",
    "expanding": """SELECT calendar_month, "LocationID", day_of_week, hour,
        ROUND(zone_mean_demand, 6) AS zone_mean_demand, ROUND(zone_hour_mean, 6) AS zone_hour_mean,
        ROUND(zone_dow_hour_mean, 6) AS zone_dow_hour_mean FROM expanding_exact""",
    "known_exact": """SELECT calendar_month, demand, zone_hour_mean, zone_dow_hour_mean
        FROM profiled JOIN expanding_exact USING (calendar_month, "LocationID", day_of_week, hour)
        WHERE zone_dow_hour_mean IS NOT NULL""",
    "history": f"""SELECT *, CASE WHEN day_of_week IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
        {cycles(("hour", "hour", 24), ("dow", "day_of_week", 7), ("month", "month", 12))}
        FROM profiled LEFT JOIN expanding USING (calendar_month, "LocationID", day_of_week, hour)""",
    "known_history": """SELECT * FROM history WHERE zone_mean_demand IS NOT NULL
        AND zone_hour_mean IS NOT NULL AND zone_dow_hour_mean IS NOT NULL""",
    "mean_zone": """SELECT "LocationID", AVG(demand) AS zone_mean_demand FROM profiled GROUP BY 1""",
    "mean_hour": """SELECT "LocationID", hour, AVG(demand) AS zone_hour_mean
        FROM profiled GROUP BY 1, 2""",
    "mean_dow_hour": """SELECT "LocationID", day_of_week, hour, AVG(demand) AS zone_dow_hour_mean
        FROM profiled GROUP BY 1, 2, 3""",
    "slots": """SELECT "LocationID", CAST(m AS INT) AS month, CAST(d AS INT) AS day_of_week,
        CAST(h AS INT) AS hour FROM (SELECT DISTINCT "LocationID" FROM monthly_demand),
        range(1, 13) AS a(m), range(1, 8) AS b(d), range(24) AS c(h)""",
    "scoring": f"""SELECT *, CASE WHEN day_of_week IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
        {cycles(("hour", "hour", 24), ("dow", "day_of_week", 7), ("month", "month", 12))}
        FROM slots LEFT JOIN mean_zone USING ("LocationID")
        LEFT JOIN mean_hour USING ("LocationID", hour)
        LEFT JOIN mean_dow_hour USING ("LocationID", day_of_week, hour)""",
    "profile": """SELECT "LocationID" AS location_id, month, day_of_week, hour,
        greatest(zone_dow_hour_mean, 0) AS predicted_demand FROM scoring
        WHERE zone_dow_hour_mean IS NOT NULL""",
}


def with_ctes(sql: str) -> str:
    """``sql`` preceded by the expressions it mentions, directly or through others."""
    needed: list[str] = []

    def need(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\w+", text)):
            if word in CTES and word not in needed and text is not CTES[word]:
                need(CTES[word])
                if word not in needed:
                    needed.append(word)

    need(sql)
    # Materialised, so that an expression used several times is computed once.
    parts = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name].strip()})" for name in needed)
    if not parts:
        return sql
    own = sql.lstrip().removeprefix("WITH ")
    return f"WITH {parts}{',' if own != sql.lstrip() else ''}\n{own}"
