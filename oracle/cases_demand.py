"""Demand, grid, features, star tables and demand questions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from hailgrid.functions.calendar import with_future_calendar, with_time_features
from hailgrid.operators import demand as d
from hailgrid.operators import history as h
from hailgrid.operators import star as s
from hailgrid.plans import demand_queries as q
from hailgrid.sinks.writers import sink_overwrite
from oracle.inputs import END, LAST_HOUR, START
from oracle.registry import check
from oracle.sql import cycles

ROUNDED = [
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
    "rolling_mean_24h", "rolling_mean_168h", "avg_demand",
    "zone_mean_demand", "zone_hour_mean", "zone_dow_hour_mean", "predicted_demand",
]


def rounded(rows):
    """Doubles that the engines may compute with different last digits, to six places."""
    return rows.withColumns({c: F.round(c, 6) for c in ROUNDED if c in rows.columns})


@check("hourly_demand", "SELECT * FROM hourly")
def _(t):
    return d.hourly_demand(t.clean)


@check("clean_hourly_demand", "SELECT * FROM hourly")
def _(t):
    return d.clean_hourly_demand(t.trips, START, END)


@check("clean_hourly_demand_by_key", "SELECT * FROM hourly")
def _(t):
    return d.clean_hourly_demand(t.trips, START, END, filter_words=0)


@check("cross_zone_hours", "SELECT * FROM zone_hours")
def _(t):
    return d.zone_hours(t.zones, START, LAST_HOUR)


@check("complete_zone_hour_grid", "SELECT * FROM grid")
def _(t):
    return d.complete_grid(t.hourly, t.zones, START, LAST_HOUR)


@check(
    "join_demand_zones",
    'SELECT "LocationID", pickup_hour, demand, "Borough", "Zone", service_zone '
    'FROM hourly LEFT JOIN zones USING ("LocationID")',
)
def _(t):
    return d.with_zone_attributes(t.hourly, t.zones)


@check("zone_hour_daily", "SELECT * FROM daily")
def _(t):
    return d.sorted_zone_hour_daily(t.grid, t.zones)


@check("time_features", "SELECT * FROM timed_features")
def _(t):
    return rounded(with_time_features(t.grid))


@check(
    "future_calendar_features",
    f"""SELECT "LocationID", pickup_hour, demand, hour, day_of_week, month,
    CASE WHEN day_of_week IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
    {cycles(("hour", "hour", 24), ("dow", "day_of_week", 7), ("month", "month", 12))} FROM profiled""",
)
def _(t):
    return rounded(with_future_calendar(t.monthly_demand))


@check(
    "lag_features",
    'SELECT "LocationID", pickup_hour, demand, lag_1h, lag_24h, lag_168h FROM features',
)
def _(t):
    return h.with_lags(t.grid)


@check(
    "rolling_features",
    """SELECT "LocationID", pickup_hour, demand, rolling_mean_24h, history_count_24h,
    rolling_mean_168h, history_count_168h FROM features""",
)
def _(t):
    return rounded(h.with_rolling(t.grid))


@check("demand_features_in_slices", "SELECT * FROM features")
def _(t):
    return rounded(h.sliced_demand_features(t.grid, 200))


@check("demand_features", "SELECT * FROM features")
def _(t):
    return rounded(h.demand_features(t.grid))


# Month with history: February 2000 on monthly demand, the zones being all 25 nations.
MONTH = (2000, 2)
MONTH_GRID_SQL = """SELECT "LocationID", g.pickup_hour, COALESCE(demand, 0) AS demand
    FROM (SELECT "LocationID", unnest(generate_series(TIMESTAMP '2000-01-25 00:00:00',
          TIMESTAMP '2000-02-29 23:00:00', INTERVAL 1 HOUR)) AS pickup_hour FROM zones) AS g
    LEFT JOIN monthly_demand USING ("LocationID", pickup_hour)"""
MONTH_FEATURES_SQL = f"""SELECT * FROM (SELECT "LocationID", pickup_hour, demand,
    LAG(demand, 1) OVER w AS lag_1h, LAG(demand, 24) OVER w AS lag_24h,
    LAG(demand, 168) OVER w AS lag_168h, ROUND(AVG(demand) OVER k, 6) AS rolling_mean_168h,
    COUNT(demand) OVER k AS history_count_168h FROM ({MONTH_GRID_SQL})
    WINDOW w AS (PARTITION BY "LocationID" ORDER BY pickup_hour),
    k AS (PARTITION BY "LocationID" ORDER BY pickup_hour ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING))
    WHERE pickup_hour >= TIMESTAMP '2000-02-01 00:00:00'"""
MONTH_COLUMNS = [
    "LocationID", "pickup_hour", "demand", "lag_1h", "lag_24h", "lag_168h",
    "rolling_mean_168h", "history_count_168h",
]


@check("union_history", MONTH_GRID_SQL)
def _(t):
    return h.month_grid_with_history(t.monthly_demand, t.zones, *MONTH)


@check("month_boundary_features", MONTH_FEATURES_SQL)
def _(t):
    return rounded(h.month_features(t.monthly_demand, t.zones, *MONTH)).select(*MONTH_COLUMNS)


@check("trim_target_month", MONTH_FEATURES_SQL)
def _(t):
    grid = h.month_grid_with_history(t.monthly_demand, t.zones, *MONTH)
    return rounded(h.trim_to_month(h.demand_features(grid), *MONTH)).select(*MONTH_COLUMNS)


# --- Star tables ------------------------------------------------------------------------


@check("dim_zone", "SELECT * FROM dim_zone")
def _(t):
    return s.dim_zone(t.zones)


@check("dim_date", "SELECT * FROM dim_date")
def _(t):
    return s.dim_date(t.daily)


@check("fact_demand", "SELECT * FROM fact_demand")
def _(t):
    return s.fact_demand(t.daily)


@check("fact_trips", "SELECT * FROM fact_trips")
def _(t):
    return s.fact_trips(t.business)


@check("join_fact_zone", "SELECT * FROM fact_demand JOIN dim_zone USING (location_id)")
def _(t):
    return s.join_fact_zone(t.fact_demand, t.dim_zone)


@check("join_fact_payment", "SELECT * FROM fact_trips JOIN dim_payment USING (payment_type)")
def _(t):
    return s.join_fact_payment(t.fact_trips, t.dim_payment)


@check("join_fact_hour", "SELECT * FROM fact_demand JOIN dim_hour USING (hour)")
def _(t):
    return s.join_fact_hour(t.fact_demand, t.dim_hour)


@check(
    "join_fact_date",
    """SELECT f.*, d.* EXCLUDE (full_date) FROM fact_demand AS f
    JOIN dim_date AS d ON f.pickup_date = d.full_date""",
)
def _(t):
    return s.join_fact_date(t.fact_demand, t.dim_date)


@check(
    "dim_hour",
    """SELECT hour, day_part, COUNT(*) AS fact_rows FROM fact_demand JOIN dim_hour USING (hour)
    GROUP BY ALL""",
)
def _(t):
    joined = s.join_fact_hour(t.fact_demand, s.dim_hour(t.spark))
    return joined.groupBy("hour", "day_part").agg(F.count(F.lit(1)).alias("fact_rows"))


@check(
    "dim_payment",
    """SELECT p.payment_type, payment_method, COUNT(f.payment_type) AS fact_rows
    FROM dim_payment AS p LEFT JOIN fact_trips AS f USING (payment_type) GROUP BY ALL""",
)
def _(t):
    used = t.fact_trips.groupBy("payment_type").agg(F.count(F.lit(1)).alias("fact_rows"))
    return s.dim_payment(t.spark).join(used, "payment_type", "left").fillna(0, ["fact_rows"])


@check(
    "validate_fact_trips",
    """SELECT COUNT(*) AS fact_rows, CAST(SUM(trip_count) AS BIGINT) AS total_trips,
    MIN(pickup_date) AS min_date, MAX(pickup_date) AS max_date, MIN(hour) AS min_hour,
    MAX(hour) AS max_hour FROM fact_trips""",
)
def _(t):
    return s.validate_fact_trips(t.fact_trips)


# Zones of one borough are left out, so that the audit has orphans to report.
AUDIT = """SELECT 'pk_dim_zone' AS rule, CAST(COUNT(*) - COUNT(DISTINCT location_id) AS BIGINT)
    AS violations FROM some_zones
UNION ALL SELECT 'pk_dim_date', COUNT(*) - COUNT(DISTINCT full_date) FROM dim_date
UNION ALL SELECT 'pk_dim_hour', COUNT(*) - COUNT(DISTINCT hour) FROM dim_hour
UNION ALL SELECT 'pk_dim_payment', COUNT(*) - COUNT(DISTINCT payment_type) FROM dim_payment
UNION ALL SELECT 'pk_fact_demand', COUNT(*) - COUNT(DISTINCT (location_id, pickup_date, hour))
    FROM fact_demand
UNION ALL SELECT 'pk_fact_trips',
    COUNT(*) - COUNT(DISTINCT (location_id, pickup_date, hour, payment_type)) FROM fact_trips
UNION ALL SELECT 'fk_demand_zone', COUNT(*) FROM fact_demand
    WHERE location_id NOT IN (SELECT location_id FROM some_zones)
UNION ALL SELECT 'fk_demand_date', COUNT(*) FROM fact_demand
    WHERE pickup_date NOT IN (SELECT full_date FROM dim_date)
UNION ALL SELECT 'fk_demand_hour', COUNT(*) FROM fact_demand
    WHERE hour NOT IN (SELECT hour FROM dim_hour)
UNION ALL SELECT 'fk_trips_zone', COUNT(*) FROM fact_trips
    WHERE location_id NOT IN (SELECT location_id FROM some_zones)
UNION ALL SELECT 'fk_trips_date', COUNT(*) FROM fact_trips
    WHERE pickup_date NOT IN (SELECT full_date FROM dim_date)
UNION ALL SELECT 'fk_trips_hour', COUNT(*) FROM fact_trips
    WHERE hour NOT IN (SELECT hour FROM dim_hour)
UNION ALL SELECT 'fk_trips_payment', COUNT(*) FROM fact_trips
    WHERE payment_type NOT IN (SELECT payment_type FROM dim_payment)
UNION ALL SELECT 'check_month', COUNT(*) FROM dim_date WHERE NOT month BETWEEN 1 AND 12
UNION ALL SELECT 'check_weekday', COUNT(*) FROM dim_date WHERE NOT weekday_number BETWEEN 1 AND 7
UNION ALL SELECT 'check_hour', COUNT(*) FROM dim_hour WHERE NOT hour BETWEEN 0 AND 23
UNION ALL SELECT 'check_demand', COUNT(*) FROM fact_demand WHERE NOT demand >= 0"""


def stored_facts(t):
    """Both fact tables written and read back: the audit reads each of them several times."""
    stored = []
    for table in (t.fact_demand, t.fact_trips):
        path = t.folder("facts")
        sink_overwrite(table, path)
        stored.append(t.spark.read.parquet(path))
    return stored


@check("star_constraints", AUDIT.replace("some_zones", "dim_zone"))
def _(t):
    demand, trips = stored_facts(t)
    dates = s.dim_date(demand, "pickup_date")
    return s.star_constraints(t.dim_zone, dates, t.dim_hour, t.dim_payment, demand, trips)


@check(
    "star_constraints_violated",
    AUDIT.replace("some_zones", "(SELECT * FROM dim_zone WHERE borough <> 'ASIA')"),
)
def _(t):
    known = t.dim_zone.where("borough <> 'ASIA'")
    demand, trips = stored_facts(t)
    dates = s.dim_date(demand, "pickup_date")
    return s.star_constraints(known, dates, t.dim_hour, t.dim_payment, demand, trips)


# --- Questions --------------------------------------------------------------------------

ZONE = 17
FIRST, LAST = date(2024, 1, 3), date(2024, 1, 25)
ZONE_ROWS = f"""fact_demand AS f JOIN dim_zone AS z USING (location_id)
    WHERE location_id = {ZONE} AND pickup_date >= DATE '{FIRST}' AND pickup_date <= DATE '{LAST}'"""
ZONE_LABELS = 'location_id AS "LocationID", borough AS "Borough", zone AS "Zone", service_zone'
TOTALS = """ROUND(AVG(demand), 6) AS avg_demand, CAST(SUM(demand) AS BIGINT) AS total_demand"""


@check(
    "demand_date_range",
    "SELECT MIN(pickup_date) AS min_date, MAX(pickup_date) AS max_date FROM fact_demand",
)
def _(t):
    return q.demand_date_range(t.fact_demand)


@check(
    "zone_demand_over_time",
    f"""SELECT {ZONE_LABELS}, pickup_date AS date, CAST(SUM(demand) AS BIGINT) AS total_demand
    FROM {ZONE_ROWS} GROUP BY ALL""",
)
def _(t):
    return q.zone_demand_over_time(t.fact_demand, t.dim_zone, ZONE, FIRST, LAST)


@check("zone_demand_by_hour", f"SELECT {ZONE_LABELS}, hour, {TOTALS} FROM {ZONE_ROWS} GROUP BY ALL")
def _(t):
    return q.zone_demand_by_hour(t.fact_demand, t.dim_zone, t.dim_hour, ZONE, FIRST, LAST)


@check(
    "zone_demand_by_weekday",
    f"""SELECT {ZONE_LABELS}, weekday_number, weekday, {TOTALS}
    FROM {ZONE_ROWS.replace("WHERE", "JOIN dim_date AS d ON f.pickup_date = d.full_date WHERE")}
    GROUP BY ALL""",
)
def _(t):
    return q.zone_demand_by_weekday(t.fact_demand, t.dim_zone, t.dim_date, ZONE, FIRST, LAST)


@check("demand_by_hour", f"SELECT hour, {TOTALS} FROM fact_demand GROUP BY 1")
def _(t):
    return q.demand_by_hour(t.fact_demand, t.dim_hour)


@check(
    "demand_by_weekday",
    f"""SELECT weekday_number, weekday, {TOTALS} FROM fact_demand
    JOIN dim_date ON pickup_date = full_date GROUP BY 1, 2""",
)
def _(t):
    return q.demand_by_weekday(t.fact_demand, t.dim_date)


OVER_TIME = """SELECT pickup_date AS pickup_hour, CAST(SUM(demand) AS BIGINT) AS total_demand
    FROM fact_demand {0} GROUP BY 1"""


@check("demand_over_time", OVER_TIME.format(""))
def _(t):
    return q.demand_over_time(t.fact_demand)


@check(
    "demand_over_time_bounded",
    OVER_TIME.format(f"WHERE pickup_date BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"),
)
def _(t):
    return q.demand_over_time(t.fact_demand, FIRST, LAST)


TOP_ZONES = f"""SELECT {ZONE_LABELS}, ROUND(AVG(demand), 6) AS avg_hourly_demand,
    CAST(SUM(demand) AS BIGINT) AS total_demand FROM fact_demand JOIN dim_zone USING (location_id)
    GROUP BY ALL ORDER BY total_demand DESC, "LocationID" LIMIT {{0}}"""


@check("top_zones", TOP_ZONES.format(10))
def _(t):
    return q.top_zones(t.fact_demand, t.dim_zone)


@check("top_k_param", TOP_ZONES.format(3))
def _(t):
    return q.top_zones(t.fact_demand, t.dim_zone, 3)


# All orders; days without any are filled with zero.
@check(
    "daily_resample",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n FROM orders GROUP BY 1)
    SELECT CAST(s.day AS DATE) AS pickup_hour, CAST(COALESCE(n, 0) AS BIGINT) AS total_demand
    FROM (SELECT unnest(generate_series(MIN(day), MAX(day), INTERVAL 1 DAY)) AS day FROM d) AS s
    LEFT JOIN d ON CAST(s.day AS DATE) = d.day""",
)
def _(t):
    daily = t.table("orders").groupBy(F.to_date("o_orderdate").alias("pickup_hour")).agg(
        F.count(F.lit(1)).alias("total_demand")
    )
    return q.daily_resample(daily)


DAILY = f"""(SELECT pickup_date, CAST(SUM(demand) AS BIGINT) AS n FROM fact_demand
    WHERE location_id = {ZONE} GROUP BY 1)"""


@check(
    "zone_kpis",
    f"""SELECT CAST(SUM(n) AS BIGINT) AS total_demand, ROUND(AVG(n), 6) AS avg_daily_demand,
    MAX(n) AS peak_daily_demand,
    (SELECT pickup_date FROM {DAILY} ORDER BY n DESC, pickup_date LIMIT 1) AS peak_date
    FROM {DAILY}""",
)
def _(t):
    return q.zone_kpis(t.fact_demand, ZONE)


INSIGHTS = f"""SELECT (SELECT hour FROM h ORDER BY avg_demand DESC, hour LIMIT 1) AS peak_hour,
    (SELECT MAX(avg_demand) FROM h) AS peak_hour_demand,
    (SELECT hour FROM h ORDER BY avg_demand, hour LIMIT 1) AS low_hour,
    (SELECT MIN(avg_demand) FROM h) AS low_hour_demand,
    (SELECT weekday FROM w ORDER BY avg_demand DESC, weekday_number LIMIT 1) AS peak_weekday,
    (SELECT MAX(avg_demand) FROM w) AS peak_weekday_demand,
    ROUND(((SELECT MAX(avg_demand) FROM h) / (SELECT AVG(avg_demand) FROM h) - 1) * 100, 4)
    AS peak_vs_average_pct"""


@check(
    "demand_insights",
    f"""WITH h AS (SELECT hour, ROUND(AVG(demand), 6) AS avg_demand FROM fact_demand
      WHERE location_id = {ZONE} GROUP BY 1),
    w AS (SELECT weekday, weekday_number, ROUND(AVG(demand), 6) AS avg_demand FROM fact_demand
      JOIN dim_date ON pickup_date = full_date WHERE location_id = {ZONE} GROUP BY 1, 2)
    {INSIGHTS}""",
)
def _(t):
    by_hour = q.zone_demand_by_hour(t.fact_demand, t.dim_zone, t.dim_hour, ZONE)
    by_weekday = q.zone_demand_by_weekday(t.fact_demand, t.dim_zone, t.dim_date, ZONE)
    return q.demand_insights(by_hour, by_weekday)
