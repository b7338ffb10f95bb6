"""Data-quality profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from hailgrid.fixed import (
    AMOUNT_QUANTILES,
    DISTANCE_QUANTILES,
    DURATION_QUANTILES,
    MONEY_COLUMNS,
    RATIO_QUANTILES,
    TOTAL_COMPONENTS,
    UPPER_TAIL_QUANTILES,
)
from hailgrid.operators import profiling as p
from oracle.registry import check
from oracle.sql import KEY, exact_mean, ntz

TRIP_COLUMNS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID",
    "payment_type", "trip_distance", "fare_amount", "total_amount", "tip_amount", "tolls_amount",
    "congestion_surcharge", "Airport_fee", "cbd_congestion_fee", "passenger_count", "RatecodeID",
    "store_and_fwd_flag", "extra", "mta_tax", "improvement_surcharge",
]


def count_if(**tests: str) -> str:
    return ", ".join(f"COUNT(*) FILTER (WHERE {test}) AS {name}" for name, test in tests.items())


@check(
    "null_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) - COUNT("{c}") AS null_count,
        ROUND((COUNT(*) - COUNT("{c}")) * 100 / COUNT(*), 6) AS null_pct FROM trips"""
        for c in TRIP_COLUMNS
    ),
)
def _(t):
    return p.null_profile(t.trips)


@check(
    "range_profile",
    """SELECT MIN(trip_distance) AS min_trip_distance, MAX(trip_distance) AS max_trip_distance,
    MIN(fare_amount) AS min_fare, MAX(fare_amount) AS max_fare,
    MIN(passenger_count) AS min_passengers, MAX(passenger_count) AS max_passengers,
    MIN(tpep_pickup_datetime) AS first_pickup, MAX(tpep_pickup_datetime) AS last_pickup,
    MIN(tpep_dropoff_datetime) AS first_dropoff, MAX(tpep_dropoff_datetime) AS last_dropoff
    FROM trips""",
)
def _(t):
    return p.range_profile(t.trips)


# A narrower window than the month, so that there are trips on both sides of it.
EARLY, LATE = "2024-01-05 00:00:00", "2024-01-25 00:00:00"


@check(
    "out_of_window_counts",
    "SELECT "
    + count_if(
        pickup_before=f"tpep_pickup_datetime < {ntz(EARLY)}",
        pickup_after=f"tpep_pickup_datetime >= {ntz(LATE)}",
        dropoff_before=f"tpep_dropoff_datetime < {ntz(EARLY)}",
        dropoff_after=f"tpep_dropoff_datetime >= {ntz(LATE)}",
        dropoff_before_pickup="tpep_dropoff_datetime < tpep_pickup_datetime",
    )
    + " FROM trips",
)
def _(t):
    return p.out_of_window_counts(t.trips, EARLY, LATE)


MINUTES = """(SELECT CAST((epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime))
    // 60000000 AS BIGINT) AS m FROM trips)"""


@check(
    "duration_profile",
    f"""SELECT MIN(m) AS min_duration, MAX(m) AS max_duration, ROUND(AVG(m), 6) AS avg_duration,
    {count_if(negative="m < 0", zero="m = 0", over_60="m > 60", over_120="m > 120", over_180="m > 180")}
    FROM {MINUTES}""",
)
def _(t):
    return p.duration_profile(t.trips)


@check(
    "distance_profile",
    "SELECT "
    + count_if(
        zero_distance="trip_distance = 0",
        negative_distance="trip_distance < 0",
        over_50="trip_distance > 50",
        over_100="trip_distance > 100",
        over_500="trip_distance > 500",
    )
    + " FROM trips",
)
def _(t):
    return p.distance_profile(t.trips)


@check(
    "distance_histogram", "SELECT trip_distance, COUNT(*) AS trip_count FROM trips GROUP BY 1"
)
def _(t):
    return p.distance_histogram(t.trips)


def quantile_sql(source: str, columns: dict[str, str], levels: list[float]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, CAST({q} AS DOUBLE) AS probability,
        CAST(quantile_disc({value}, {q}) AS DOUBLE) AS quantile_value FROM {source}"""
        for name, value in columns.items()
        for q in levels
    )


@check(
    "duration_quantiles",
    quantile_sql(MINUTES, {"trip_duration_minutes": "m"}, DURATION_QUANTILES),
)
def _(t):
    return p.duration_quantiles(t.trips)


@check(
    "distance_quantiles",
    quantile_sql("trips", {"trip_distance": "trip_distance"}, DISTANCE_QUANTILES),
)
def _(t):
    return p.distance_quantiles(t.trips)


AMOUNTS = {c: c for c in MONEY_COLUMNS}


@check("amount_quantiles", quantile_sql("clean", AMOUNTS, AMOUNT_QUANTILES))
def _(t):
    return p.amount_quantiles(t.clean)


@check("amount_quantiles_business", quantile_sql("standard", AMOUNTS, UPPER_TAIL_QUANTILES))
def _(t):
    return p.amount_quantiles(t.standard, UPPER_TAIL_QUANTILES)


RATIOS = {
    name: f"CASE WHEN {name} >= 0 THEN {name} END"
    for name in ("duration_minutes", "speed_mph", "fare_per_mile")
}


@check(
    "ratio_quantiles",
    f"""SELECT column_name, probability, ROUND(quantile_value, 6) AS quantile_value
    FROM ({quantile_sql("standard", RATIOS, RATIO_QUANTILES)})""",
)
def _(t):
    return p.ratio_quantiles(t.standard).withColumn("quantile_value", F.round("quantile_value", 6))


@check(
    "exact_duplicates",
    """SELECT a AS total_rows, d AS distinct_rows, a - d AS duplicate_rows
    FROM (SELECT COUNT(*) AS a FROM trips),
    (SELECT COUNT(*) AS d FROM (SELECT DISTINCT * FROM trips))""",
)
def _(t):
    return p.exact_duplicates(t.trips)


@check(
    "duplicate_groups",
    f"""SELECT {KEY}, COUNT(*) AS records,
    list_sort(list(DISTINCT fare_amount)) AS fare_amounts,
    list_sort(list(DISTINCT total_amount)) AS total_amounts
    FROM trips GROUP BY ALL HAVING COUNT(*) > 1""",
)
def _(t):
    return p.duplicate_groups(t.trips)


REPEATED = f"(SELECT {KEY}, COUNT(*) AS n FROM trips GROUP BY ALL HAVING COUNT(*) > 1)"


@check(
    "duplicate_summary",
    f"""SELECT COUNT(*) AS duplicate_groups, CAST(SUM(n) AS BIGINT) AS records,
    CAST(SUM(n - 1) AS BIGINT) AS extra_records FROM {REPEATED}""",
)
def _(t):
    return p.duplicate_summary(t.trips)


@check(
    "duplicate_summary_by_vendor",
    f"""SELECT "VendorID", COUNT(*) AS duplicate_groups, CAST(SUM(n) AS BIGINT) AS records
    FROM {REPEATED} GROUP BY 1""",
)
def _(t):
    return p.duplicate_summary_by_vendor(t.trips)


@check(
    "distinct_zones",
    """SELECT MIN("PULocationID") AS min_zone, MAX("PULocationID") AS max_zone,
    COUNT(DISTINCT "PULocationID") AS distinct_zones FROM timed""",
)
def _(t):
    return p.distinct_zones(t.timed)


@check(
    "distinct_zones_lookup",
    """SELECT MIN("LocationID") AS min_zone, MAX("LocationID") AS max_zone,
    COUNT(DISTINCT "LocationID") AS distinct_zones FROM zones""",
)
def _(t):
    return p.distinct_zones(t.zones, "LocationID")


@check(
    "zone_pickup_ranking", 'SELECT "PULocationID", COUNT(*) AS pickups FROM timed GROUP BY 1'
)
def _(t):
    return p.zone_pickup_ranking(t.timed)


INTEGRITY = """SELECT MIN(demand) AS min_demand, MAX(demand) AS max_demand,
    ROUND(AVG(demand), 6) AS avg_demand, COUNT(*) FILTER (WHERE demand = 0) AS zero_demand_hours,
    CAST(SUM(demand) AS BIGINT) AS total_demand FROM {0}"""


@check("grid_integrity", INTEGRITY.format("grid"))
def _(t):
    return p.grid_integrity(t.grid)


@check("grid_integrity_sparse", INTEGRITY.format("hourly"))
def _(t):
    return p.grid_integrity(t.hourly)


EFFECT = """SELECT b AS raw_records, a AS cleaned_records, b - a AS removed_records,
    ROUND((b - a) * 100 / b, 6) AS removed_pct
    FROM (SELECT COUNT(*) AS b FROM {0}), (SELECT COUNT(*) AS a FROM {1})"""


@check("cleaning_effect", EFFECT.format("trips", "clean"))
def _(t):
    return p.cleaning_effect(t.trips, t.clean)


@check("cleaning_effect_business", EFFECT.format("clean", "standard"))
def _(t):
    return p.cleaning_effect(t.clean, t.standard)


@check("cleaning_effect_outliers", EFFECT.format("standard", "business"))
def _(t):
    return p.cleaning_effect(t.standard, t.business)


@check(
    "numeric_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT({c}) AS value_count, MIN({c}) AS min_value,
        {exact_mean(c)} AS mean_value, MAX({c}) AS max_value FROM clean"""
        for c in MONEY_COLUMNS
    ),
)
def _(t):
    return p.numeric_summary(t.clean)


@check(
    "quality_checks",
    "SELECT "
    + count_if(
        negative_fares="fare_amount < 0",
        negative_total_amounts="total_amount < 0",
        negative_tips="tip_amount < 0",
        zero_distance_trips="trip_distance = 0",
        negative_distance_trips="trip_distance < 0",
    )
    + " FROM clean",
)
def _(t):
    return p.quality_checks(t.clean)


NEGATIVE_MEANS = f"""COUNT(*) AS trip_count, {exact_mean("fare_amount")} AS avg_fare,
    {exact_mean("total_amount")} AS avg_total"""
NEGATIVE_DISTANCE = f"{NEGATIVE_MEANS}, {exact_mean('trip_distance')} AS avg_distance"


@check(
    "negative_fares_by_payment",
    f"SELECT payment_type, {NEGATIVE_MEANS} FROM clean WHERE fare_amount < 0 GROUP BY 1",
)
def _(t):
    return p.negative_fares_by_payment(t.clean)


@check(
    "negative_fares_by_ratecode",
    f"""SELECT payment_type, "RatecodeID" IS NULL AS ratecode_missing, {NEGATIVE_DISTANCE}
    FROM clean WHERE fare_amount < 0 GROUP BY 1, 2""",
)
def _(t):
    return p.negative_fares_by_ratecode(t.clean)


@check(
    "negative_fares_by_month",
    f"""SELECT CAST(month(tpep_pickup_datetime) AS INT) AS month, {NEGATIVE_DISTANCE}
    FROM clean WHERE fare_amount < 0 AND payment_type = 0 GROUP BY 1""",
)
def _(t):
    return p.negative_fares_by_month(t.clean)


COMPONENT_SUM = " + ".join(
    f'COALESCE(CAST("{c}" AS DECIMAL(18,6)), CAST(0 AS DECIMAL(18,6)))' for c in TOTAL_COMPONENTS
)
GAPS = f"""(SELECT *, CAST({COMPONENT_SUM} AS DOUBLE) AS calculated_total,
    CAST(CAST(total_amount AS DECIMAL(18,6)) - ({COMPONENT_SUM}) AS DOUBLE) AS total_difference
    FROM clean WHERE payment_type = 0)"""


@check(
    "total_reconciliation",
    f"""SELECT COUNT(*) AS records, {exact_mean("total_difference")} AS avg_difference,
    MIN(total_difference) AS min_difference, MAX(total_difference) AS max_difference,
    {exact_mean("abs(total_difference)")} AS avg_abs_difference FROM {GAPS}""",
)
def _(t):
    return p.total_reconciliation(t.clean)


@check(
    "total_reconciliation_worst",
    f"""SELECT fare_amount, calculated_total, total_amount, total_difference, trip_distance
    FROM {GAPS} ORDER BY abs(total_difference) DESC, fare_amount DESC, calculated_total DESC,
    total_amount DESC, total_difference DESC, trip_distance DESC LIMIT 20""",
)
def _(t):
    return p.worst_reconciliations(t.clean)


@check(
    "distance_bin_profile",
    f"""SELECT CAST(floor(trip_distance) AS BIGINT) AS distance_bin, COUNT(*) AS trip_count,
    {exact_mean("total_difference")} AS avg_total_difference,
    {exact_mean("fare_amount")} AS avg_fare_amount, {exact_mean("total_amount")} AS avg_total_amount
    FROM {GAPS} WHERE trip_distance >= 0 AND trip_distance <= 30 GROUP BY 1""",
)
def _(t):
    return p.distance_bin_profile(t.clean)


@check(
    "payment_type_profile",
    f"""SELECT payment_type, COUNT(*) AS trip_count, {exact_mean("fare_amount")} AS avg_fare,
    {exact_mean("total_amount")} AS avg_total, {exact_mean("tip_amount")} AS avg_tip,
    {exact_mean("trip_distance")} AS avg_distance,
    ROUND(CAST(SUM(CAST(total_amount AS DECIMAL(18,6))) AS DOUBLE), 2) AS total_amount_sum
    FROM clean GROUP BY 1""",
)
def _(t):
    return p.payment_type_profile(t.clean)


@check(
    "cleaning_audit",
    "SELECT COUNT(*) AS cleaned_trips, "
    + count_if(
        payment_type_0="payment_type = 0",
        negative_fare="fare_amount < 0",
        negative_total="total_amount < 0",
        missing_payment_type="payment_type IS NULL",
        other_payment_type="payment_type NOT IN (0, 1, 2, 3, 4, 5)",
    )
    + " FROM clean",
)
def _(t):
    return p.cleaning_audit(t.clean)


@check(
    "cleaning_breakdown",
    """SELECT business_status, COUNT(*) AS trip_count,
    ROUND(COUNT(*) * 100 / (SELECT COUNT(*) FROM clean), 2) AS share_pct
    FROM (SELECT CASE WHEN payment_type = 0 THEN 'Excluded: payment_type 0'
      WHEN payment_type IS NULL THEN 'Excluded: missing payment type'
      WHEN fare_amount < 0 THEN 'Excluded: negative fare'
      WHEN total_amount < 0 THEN 'Excluded: negative total'
      WHEN payment_type NOT IN (1, 2, 3, 4, 5) THEN 'Excluded: other payment type'
      ELSE 'Included in business dataset' END AS business_status FROM clean) GROUP BY 1""",
)
def _(t):
    return p.cleaning_breakdown(t.clean)


@check(
    "implausible_counts",
    "SELECT "
    + count_if(
        zero_duration="duration_minutes = 0",
        speed_over_100="speed_mph > 100",
        fare_per_mile_over_100="fare_per_mile > 100",
    )
    + " FROM standard",
)
def _(t):
    return p.implausible_counts(t.standard)

