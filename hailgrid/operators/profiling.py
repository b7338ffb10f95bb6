"""Data-quality profiles of trip tables.

Counts and ranges are computed in one pass each. Nothing is collected to the driver, and no
single key's rows are gathered in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hailgrid.fixed import (
    AMOUNT_QUANTILES,
    BUSINESS_PAYMENT_TYPES,
    DISTANCE_QUANTILES,
    DROPOFF,
    DURATION_QUANTILES,
    JOINTLY_EMPTY_COLUMNS,
    MAX_FARE_PER_MILE,
    MAX_SPEED_MPH,
    MONEY_COLUMNS,
    PICKUP,
    RATIO_QUANTILES,
    TOTAL_COMPONENTS,
    TRIP_KEY,
)
from hailgrid.functions.calendar import moment, seconds_between
from hailgrid.functions.money import UNITS, exact_mean, exact_sum, units
from hailgrid.operators.sampling import keyed_sample

# Buckets of a value for each power of two: a bucket is 0.02 % wide.
STEPS = 4096


def _rows() -> Column:
    return F.count(F.lit(1))


def _counts(rows: DataFrame, **conditions: Column) -> DataFrame:
    return rows.agg(*[F.count_if(test).alias(name) for name, test in conditions.items()])


def _share(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * 100, whole), 6)


# --- Completeness and ranges ------------------------------------------------------------


def null_profile(trips: DataFrame) -> DataFrame:
    """Null count and percentage per column, one row per column."""
    nulls = trips.agg(
        _rows().alias("row_count"), *[F.count_if(F.col(c).isNull()).alias(c) for c in trips.columns]
    )
    return nulls.unpivot(["row_count"], trips.columns, "column_name", "null_count").select(
        "column_name",
        "null_count",
        _share(F.col("null_count"), F.col("row_count")).alias("null_pct"),
    )


def range_profile(trips: DataFrame) -> DataFrame:
    """Smallest and largest distance, fare, passenger count, pickup and drop-off."""
    names = {
        "trip_distance": ("min_trip_distance", "max_trip_distance"),
        "fare_amount": ("min_fare", "max_fare"),
        "passenger_count": ("min_passengers", "max_passengers"),
        PICKUP: ("first_pickup", "last_pickup"),
        DROPOFF: ("first_dropoff", "last_dropoff"),
    }
    ends = [
        end
        for column, (low, high) in names.items()
        for end in (F.min(column).alias(low), F.max(column).alias(high))
    ]
    return trips.agg(*ends)


def out_of_window_counts(trips: DataFrame, start, end) -> DataFrame:
    """Pickups and drop-offs outside [start, end), and drop-offs before their pickup."""
    pickup, dropoff = F.col(PICKUP), F.col(DROPOFF)
    return _counts(
        trips,
        pickup_before=pickup < moment(trips, PICKUP, start),
        pickup_after=pickup >= moment(trips, PICKUP, end),
        dropoff_before=dropoff < moment(trips, DROPOFF, start),
        dropoff_after=dropoff >= moment(trips, DROPOFF, end),
        dropoff_before_pickup=dropoff < pickup,
    )


def with_whole_minutes(trips: DataFrame) -> DataFrame:
    """Duration in whole minutes, cut toward zero."""
    minutes = (seconds_between(PICKUP, DROPOFF, exact=True) / 60).cast("bigint")
    return trips.withColumn("trip_duration_minutes", minutes)


def duration_profile(trips: DataFrame) -> DataFrame:
    minutes = F.col("trip_duration_minutes")
    over = [F.count_if(minutes > n).alias(f"over_{n}") for n in (60, 120, 180)]
    return with_whole_minutes(trips).agg(
        F.min(minutes).alias("min_duration"),
        F.max(minutes).alias("max_duration"),
        F.round(F.avg(minutes), 6).alias("avg_duration"),
        F.count_if(minutes < 0).alias("negative"),
        F.count_if(minutes == 0).alias("zero"),
        *over,
    )


def distance_profile(trips: DataFrame) -> DataFrame:
    miles = F.col("trip_distance")
    return _counts(
        trips,
        zero_distance=miles == 0,
        negative_distance=miles < 0,
        over_50=miles > 50,
        over_100=miles > 100,
        over_500=miles > 500,
    )


def distance_histogram(trips: DataFrame) -> DataFrame:
    """How often each distance occurs, longest first."""
    return (
        trips.groupBy("trip_distance")
        .agg(_rows().alias("trip_count"))
        .orderBy(F.desc("trip_distance"))
    )


def extreme_records(rows: DataFrame, column: str, threshold: float) -> DataFrame:
    """Records above a threshold with their derived ratios, largest first."""
    shown = [
        PICKUP,
        DROPOFF,
        "PULocationID",
        "DOLocationID",
        "trip_distance",
        "duration_minutes",
        "speed_mph",
        "fare_amount",
        "fare_per_mile",
        "total_amount",
        "RatecodeID",
        "payment_type",
    ]
    rest = [name for name in shown if name not in (column, PICKUP)]
    return rows.where(F.col(column) > threshold).select(*shown).orderBy(F.desc(column), PICKUP, *rest)


# --- Quantiles --------------------------------------------------------------------------


def value_bucket(value: Column) -> Column:
    """A whole number that rises with the value: sign and ``STEPS`` steps per power of two."""
    steps = F.floor(F.log2(1 + F.abs(value) * 1024) * STEPS)
    return F.when(value < 0, -steps).otherwise(steps)


def _holding(counts: DataFrame, whole: list[str], part: str, wanted: DataFrame) -> DataFrame:
    """For each wanted rank the part that holds it, and the rank within that part.

    ``counts`` has ``n`` rows for each part of ``whole``; ``wanted`` has a rank for each probability.
    """
    order = Window.partitionBy(*whole).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    held = (F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n"))
    return placed.join(wanted, whole).where(held).withColumn("rank", F.col("rank") - F.col("before"))


def quantile_table(rows: DataFrame, columns: dict[str, Column], probabilities: list[float]) -> DataFrame:
    """Exact quantiles of several columns, one row per column and probability.

    The quantile is the smallest value that a share of ``p`` of the known values does not exceed. Rows
    are counted by narrow buckets of the value; of those that hold a wanted rank the distinct values are
    counted and ordered. Both passes shuffle counts, so neither many rows nor a frequent value gather in
    a task. A column without values has no quantiles.
    """
    values = rows.select(*[value.cast("double").alias(name) for name, value in columns.items()])
    values = values.unpivot([], list(columns), "column_name", "value")
    values = values.where(F.col("value").isNotNull() & ~F.isnan("value")).withColumn("coarse", value_bucket(F.col("value")))
    counts = values.groupBy("column_name", "coarse").agg(_rows().alias("n"))
    levels = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    wanted = counts.groupBy("column_name").agg(F.sum("n").alias("known")).select("column_name", "known", levels)
    wanted = wanted.withColumn("rank", F.greatest(F.ceil(F.col("probability") * F.col("known")), F.lit(1))).drop("known")
    coarse = _holding(counts, ["column_name"], "coarse", wanted).drop("n", "before")

    # At most one bucket for each column and probability.
    whole = ["column_name", "coarse"]
    within = F.broadcast(coarse.select(*whole).distinct())
    counts = values.join(within, whole).groupBy(*whole, "value").agg(_rows().alias("n"))
    found = _holding(counts, whole, "value", coarse)
    return found.select("column_name", "probability", F.col("value").alias("quantile_value"))


def duration_quantiles(trips: DataFrame) -> DataFrame:
    minutes = {"trip_duration_minutes": F.col("trip_duration_minutes")}
    return quantile_table(with_whole_minutes(trips), minutes, DURATION_QUANTILES)


def distance_quantiles(trips: DataFrame) -> DataFrame:
    return quantile_table(trips, {"trip_distance": F.col("trip_distance")}, DISTANCE_QUANTILES)


def amount_quantiles(trips: DataFrame, probabilities: list[float] = AMOUNT_QUANTILES) -> DataFrame:
    return quantile_table(trips, {c: F.col(c) for c in MONEY_COLUMNS}, probabilities)


def ratio_quantiles(rows: DataFrame) -> DataFrame:
    """Quantiles of duration, speed and fare per mile over known, non-negative values."""
    names = ["duration_minutes", "speed_mph", "fare_per_mile"]
    known = {name: F.when(F.col(name) >= 0, F.col(name)) for name in names}
    return quantile_table(rows, known, RATIO_QUANTILES)


# --- Duplicates -------------------------------------------------------------------------


def exact_duplicates(trips: DataFrame) -> DataFrame:
    """Rows, distinct rows and the difference, from one grouping of identical rows."""
    groups = trips.groupBy(*trips.columns).agg(_rows().alias("copies"))
    return groups.agg(
        F.sum("copies").alias("total_rows"),
        _rows().alias("distinct_rows"),
        (F.sum("copies") - _rows()).alias("duplicate_rows"),
    )


def duplicate_groups(trips: DataFrame) -> DataFrame:
    """Trip keys with several records, with the sets of fares and totals seen.

    Repeated keys are found first, from counts; only their trips are reduced to distinct pairs of fare
    and total, and gathered. A row is as long as its key has different fares; ``duplicate_fares`` has
    them in long form.
    """
    fares = duplicate_fares(trips)
    return (
        fares.groupBy(*TRIP_KEY)
        .agg(
            F.sum("copies").alias("records"),
            F.sort_array(F.collect_set("fare_amount")).alias("fare_amounts"),
            F.sort_array(F.collect_set("total_amount")).alias("total_amounts"),
        )
        .orderBy(F.desc("records"), *TRIP_KEY)
    )


def duplicate_fares(trips: DataFrame) -> DataFrame:
    """One row per repeated trip key, fare and total, with its number of records."""
    repeated = _repeated_keys(trips).select(*[F.col(name).alias(f"repeated_{name}") for name in TRIP_KEY])
    same = [F.col(name).eqNullSafe(F.col(f"repeated_{name}")) for name in TRIP_KEY]
    pairs = trips.join(repeated, reduce(Column.__and__, same), "left_semi")
    return pairs.groupBy(*TRIP_KEY, "fare_amount", "total_amount").agg(_rows().alias("copies"))


def _repeated_keys(trips: DataFrame) -> DataFrame:
    return trips.groupBy(*TRIP_KEY).agg(_rows().alias("records")).where("records > 1")


def duplicate_summary(trips: DataFrame) -> DataFrame:
    """Groups, their records, and records beyond the first of each group."""
    return _repeated_keys(trips).agg(
        _rows().alias("duplicate_groups"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.coalesce(F.sum(F.col("records") - 1), F.lit(0)).alias("extra_records"),
    )


def duplicate_summary_by_vendor(trips: DataFrame) -> DataFrame:
    return (
        _repeated_keys(trips)
        .groupBy("VendorID")
        .agg(_rows().alias("duplicate_groups"), F.sum("records").alias("records"))
        .orderBy("VendorID")
    )


# --- Structured missingness -------------------------------------------------------------


def all_null_group(trips: DataFrame) -> DataFrame:
    """Records on which five optional columns are all empty."""
    return trips.where(F.coalesce(*[F.col(c).cast("string") for c in JOINTLY_EMPTY_COLUMNS]).isNull())


def all_null_counts(trips: DataFrame, by: str) -> DataFrame:
    """Size of that group per vendor or payment type."""
    return all_null_group(trips).groupBy(by).agg(_rows().alias("trip_count")).orderBy(by)


# --- Zones and grid ---------------------------------------------------------------------


def distinct_zones(
    rows: DataFrame, column: str = "PULocationID", approximate: bool = False
) -> DataFrame:
    """Smallest, largest and number of distinct zones, exact or from a sketch."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return rows.agg(
        F.min(column).alias("min_zone"),
        F.max(column).alias("max_zone"),
        distinct(column).alias("distinct_zones"),
    )


def zone_pickup_ranking(trips: DataFrame) -> DataFrame:
    return (
        trips.groupBy("PULocationID")
        .agg(_rows().alias("pickups"))
        .orderBy(F.desc("pickups"), "PULocationID")
    )


def grid_integrity(demand: DataFrame) -> DataFrame:
    """Range and mean of demand, empty hours, and the total that must equal the valid trips."""
    return demand.agg(
        F.min("demand").alias("min_demand"),
        F.max("demand").alias("max_demand"),
        F.round(F.avg("demand"), 6).alias("avg_demand"),
        F.count_if(F.col("demand") == 0).alias("zero_demand_hours"),
        F.sum("demand").alias("total_demand"),
    )


# --- Money ------------------------------------------------------------------------------


def cleaning_effect(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before and after a cleaning step, removed rows and their percentage."""
    sides = before.select(F.lit(1).alias("before"), F.lit(0).alias("after")).unionAll(
        after.select(F.lit(0), F.lit(1))
    )
    kept = F.sum("after")
    total = F.sum("before")
    return sides.agg(
        total.alias("raw_records"),
        kept.alias("cleaned_records"),
        (total - kept).alias("removed_records"),
        _share(total - kept, total).alias("removed_pct"),
    )


def numeric_summary(rows: DataFrame, columns: list[str] = MONEY_COLUMNS) -> DataFrame:
    """Count, minimum, mean and maximum per column, one row per column."""
    stats = rows.agg(
        *[
            F.struct(
                F.count(c).alias("value_count"),
                F.min(c).alias("min_value"),
                F.round(exact_mean(c), 6).alias("mean_value"),
                F.max(c).alias("max_value"),
            ).alias(c)
            for c in columns
        ]
    )
    return stats.unpivot([], columns, "column_name", "stats").select("column_name", "stats.*")


def quality_checks(trips: DataFrame) -> DataFrame:
    return _counts(
        trips,
        negative_fares=F.col("fare_amount") < 0,
        negative_total_amounts=F.col("total_amount") < 0,
        negative_tips=F.col("tip_amount") < 0,
        zero_distance_trips=F.col("trip_distance") == 0,
        negative_distance_trips=F.col("trip_distance") < 0,
    )


def _negative_fares(trips: DataFrame, by: list[Column], means: dict[str, str]) -> DataFrame:
    return (
        trips.where("fare_amount < 0")
        .groupBy(*by)
        .agg(
            _rows().alias("trip_count"),
            *[F.round(exact_mean(column), 6).alias(name) for name, column in means.items()],
        )
    )


FARE_MEANS = {"avg_fare": "fare_amount", "avg_total": "total_amount"}
FARE_DISTANCE_MEANS = {**FARE_MEANS, "avg_distance": "trip_distance"}


def negative_fares_by_payment(trips: DataFrame) -> DataFrame:
    by = [F.col("payment_type")]
    return _negative_fares(trips, by, FARE_MEANS).orderBy(F.desc("trip_count"), "payment_type")


def negative_fares_by_ratecode(trips: DataFrame) -> DataFrame:
    by = [F.col("payment_type"), F.col("RatecodeID").isNull().alias("ratecode_missing")]
    return _negative_fares(trips, by, FARE_DISTANCE_MEANS).orderBy(
        "payment_type", F.desc("trip_count")
    )


def negative_fares_by_month(trips: DataFrame) -> DataFrame:
    """Negative fares of payment type 0 by calendar month."""
    by = [F.month(PICKUP).alias("month")]
    return _negative_fares(trips.where("payment_type = 0"), by, FARE_DISTANCE_MEANS).orderBy("month")


def with_total_difference(trips: DataFrame) -> DataFrame:
    """The sum of the nine components (empty ones count as zero) and its gap to the total.

    Amounts are added as whole units, so a total that matches its components has a gap of
    exactly zero.
    """
    total = reduce(Column.__add__, [F.coalesce(units(c), F.lit(0)) for c in TOTAL_COMPONENTS])
    return trips.withColumns(
        {
            "calculated_total": total / UNITS,
            "total_difference": (units("total_amount") - total) / UNITS,
        }
    )


def total_reconciliation(trips: DataFrame, payment_type: int = 0) -> DataFrame:
    """Statistics of the gap between total and components for one payment type."""
    gap = F.col("total_difference")
    return with_total_difference(trips.where(F.col("payment_type") == payment_type)).agg(
        _rows().alias("records"),
        F.round(exact_mean(gap), 6).alias("avg_difference"),
        F.min(gap).alias("min_difference"),
        F.max(gap).alias("max_difference"),
        F.round(exact_mean(F.abs(gap)), 6).alias("avg_abs_difference"),
    )


def worst_reconciliations(trips: DataFrame, payment_type: int = 0, limit: int = 20) -> DataFrame:
    """The records with the largest gaps."""
    shown = ["fare_amount", "calculated_total", "total_amount", "total_difference", "trip_distance"]
    return (
        with_total_difference(trips.where(F.col("payment_type") == payment_type))
        .select(*shown)
        .orderBy(F.desc(F.abs("total_difference")), *[F.desc(c) for c in shown])
        .limit(limit)
    )


def distance_bin_profile(trips: DataFrame, payment_type: int = 0, longest: int = 30) -> DataFrame:
    """Count and mean amounts per whole mile, up to ``longest`` miles."""
    in_range = (F.col("payment_type") == payment_type) & F.col("trip_distance").between(0, longest)
    return (
        with_total_difference(trips.where(in_range))
        .groupBy(F.floor("trip_distance").alias("distance_bin"))
        .agg(
            _rows().alias("trip_count"),
            F.round(exact_mean("total_difference"), 6).alias("avg_total_difference"),
            F.round(exact_mean("fare_amount"), 6).alias("avg_fare_amount"),
            F.round(exact_mean("total_amount"), 6).alias("avg_total_amount"),
        )
        .orderBy("distance_bin")
    )


def payment_type_profile(trips: DataFrame) -> DataFrame:
    means = {"avg_fare": "fare_amount", "avg_total": "total_amount", "avg_tip": "tip_amount"}
    means["avg_distance"] = "trip_distance"
    return (
        trips.groupBy("payment_type")
        .agg(
            _rows().alias("trip_count"),
            *[F.round(exact_mean(column), 6).alias(name) for name, column in means.items()],
            F.round(exact_sum("total_amount").cast("double"), 2).alias("total_amount_sum"),
        )
        .orderBy("payment_type")
    )


def cleaning_audit(trips: DataFrame) -> DataFrame:
    """How many trips each exclusion rule hits; one trip may hit several."""
    kind = F.col("payment_type")
    return trips.agg(
        _rows().alias("cleaned_trips"),
        F.count_if(kind == 0).alias("payment_type_0"),
        F.count_if(F.col("fare_amount") < 0).alias("negative_fare"),
        F.count_if(F.col("total_amount") < 0).alias("negative_total"),
        F.count_if(kind.isNull()).alias("missing_payment_type"),
        F.count_if(~kind.isin(0, *BUSINESS_PAYMENT_TYPES)).alias("other_payment_type"),
    )


def cleaning_breakdown(trips: DataFrame) -> DataFrame:
    """Each trip under the first exclusion rule it hits: count and share of all trips."""
    kind = F.col("payment_type")
    rules = [
        (kind == 0, "Excluded: payment_type 0"),
        (kind.isNull(), "Excluded: missing payment type"),
        (F.col("fare_amount") < 0, "Excluded: negative fare"),
        (F.col("total_amount") < 0, "Excluded: negative total"),
        (~kind.isin(BUSINESS_PAYMENT_TYPES), "Excluded: other payment type"),
    ]
    status = F.lit("Included in business dataset")
    for test, label in reversed(rules):
        status = F.when(test, label).otherwise(status)
    counts = trips.groupBy(status.alias("business_status")).agg(_rows().alias("trip_count"))
    # At most one row per rule is left here, so a window over all of them is small.
    total = F.sum("trip_count").over(Window.partitionBy())
    share = F.round(F.col("trip_count") * 100 / total, 2)
    return counts.select("business_status", "trip_count", share.alias("share_pct")).orderBy(
        F.desc("trip_count"), "business_status"
    )


def implausible_counts(rows: DataFrame) -> DataFrame:
    return _counts(
        rows,
        zero_duration=F.col("duration_minutes") == 0,
        speed_over_100=F.col("speed_mph") > MAX_SPEED_MPH,
        fare_per_mile_over_100=F.col("fare_per_mile") > MAX_FARE_PER_MILE,
    )


def sample_fraction(rows: DataFrame, fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """A sample without replacement, for drawing; the same rows however they are partitioned."""
    return keyed_sample(rows.select(*MONEY_COLUMNS), fraction, seed)
