"""Sinks, published snapshots, dataset builds and streams: written, then read back."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailgrid.fixed import FACT_MEASURES, PROFILE_MODEL
from hailgrid.functions.calendar import shift_month
from hailgrid.models import evaluation as e
from hailgrid.models import historical as hist
from hailgrid.models.future import forecast_metadata, future_profiles
from hailgrid.plans import ingestion, refresh
from hailgrid.sinks import writers as w
from hailgrid.sinks.keyed_table import KeyedTable
from hailgrid.sinks.snapshots import read_snapshot, snapshot_replace
from hailgrid.sources.readers import scan_metrics_csv
from hailgrid.streaming.hourly import (
    compact_hourly_changes,
    read_hourly_changes,
    stream_hourly_demand,
    write_hourly_changes,
)
from hailgrid.streaming.ledger import RunLedger
from hailgrid.streaming.months import stream_month_increment
from oracle.cases_models import BOTH, MAE, RMSE, full_run, rounded_errors, two_models
from oracle.cases_trips import TRIP_SUMMARY, UPSERT_KEY, trip_summary, upsert_sides, upsert_sql
from oracle.registry import check


@check("sink_overwrite", "SELECT * FROM hourly")
def _(t):
    path = t.folder("hourly")
    for rows in (t.hourly.where("demand > 1"), t.hourly):
        w.sink_overwrite(rows, path)
    return t.spark.read.parquet(path)


# The second write replaces the months from 2000 on only.
@check(
    "sink_month_partition",
    """SELECT "LocationID", pickup_hour, demand + CASE WHEN pickup_hour >= TIMESTAMP '2000-01-01'
    THEN 1 ELSE 0 END AS demand, CAST(year(pickup_hour) AS INT) AS year,
    CAST(month(pickup_hour) AS INT) AS month FROM monthly_demand""",
)
def _(t):
    root = t.folder("monthly")
    w.sink_months(t.monthly_demand, root, "pickup_hour")
    recent = t.monthly_demand.where("pickup_hour >= TIMESTAMP_NTZ '2000-01-01'")
    w.sink_months(recent.withColumn("demand", F.col("demand") + 1), root, "pickup_hour")
    return t.spark.read.parquet(root)


@check("sink_business_partitioned", TRIP_SUMMARY.format("business"))
def _(t):
    root = t.folder("business")
    w.sink_months(t.business, root, "pickup_date", replace_all=True)
    return trip_summary(t.spark.read.parquet(root).where("year = 2024 AND month = 1"))


@check("sink_zone_hour_daily", "SELECT * FROM daily")
def _(t):
    root = t.folder("daily")
    w.sink_zone_hour_daily(t.daily, root)
    return t.spark.read.parquet(root).drop("year", "month")


METRICS = f"""SELECT model, ROUND({MAE}, 5) AS mae, ROUND({RMSE}, 5) AS rmse
    FROM ({BOTH}) GROUP BY 1"""


def metrics_file(t) -> str:
    path = t.folder("metrics")
    w.sink_metrics_csv(rounded_errors(e.regression_metrics(two_models(t), "model")), path)
    return path


@check("sink_metrics_csv", METRICS)
def _(t):
    return t.spark.read.csv(metrics_file(t), header=True, inferSchema=True)


@check("scan_metrics_csv", METRICS)
def _(t):
    return scan_metrics_csv(t.spark, metrics_file(t), "historical_metrics")


@check("sink_model")
def _(t):
    path = t.folder("model")
    w.sink_model(full_run(t).model, path)
    return hist.feature_importance(RandomForestRegressionModel.load(path), t.spark)


@check(
    "snapshot_replace",
    """SELECT * REPLACE (ROUND(predicted_demand, 6) AS predicted_demand) FROM profile""",
)
def _(t):
    root = t.folder("snapshot")
    profile = future_profiles(t.monthly_demand)
    first = profile.where("month = 1")
    for table in (first, profile):
        metadata = forecast_metadata(t.monthly_demand, table, PROFILE_MODEL)
        snapshot_replace(
            t.spark, root, {"future_demand_profile": table, "future_forecast_metadata": metadata}
        )
    stored = read_snapshot(t.spark, root, "future_demand_profile")
    return stored.withColumn("predicted_demand", F.round("predicted_demand", 6))


@check("historical_serving_snapshot")
def _(t):
    root = t.folder("serving")
    run = hist.store_run(full_run(t), t.folder("run"))
    snapshot_replace(t.spark, root, hist.historical_serving_tables(run, t.zones))
    return read_snapshot(t.spark, root, "historical_model_prediction").drop("generated_at")


# Every column of every star table, in one number each: sums, days since 1970, lengths of texts.
STAR_TABLES = {
    "dim_zone": {"location_id": "n", "borough": "t", "zone": "t", "service_zone": "t"},
    "dim_date": {"full_date": "d", "year": "n", "month": "n", "month_name": "t", "day": "n", "weekday_number": "n", "weekday": "t", "is_weekend": "b"},
    "dim_hour": {"hour": "n", "day_part": "t"},
    "dim_payment": {"payment_type": "n", "payment_method": "t"},
    "fact_demand": {"location_id": "n", "pickup_date": "d", "hour": "n", "demand": "n"},
    "fact_trips": {"location_id": "n", "pickup_date": "d", "hour": "n", "payment_type": "n", "trip_count": "n", **{name: "n" for name, _ in FACT_MEASURES}},
}
IN_SQL = {"n": "{0}", "d": "date_diff('day', DATE '1970-01-01', {0})", "t": "length({0})", "b": "CAST({0} AS INT)"}
STAR_SUMS = " UNION ALL ".join(
    f"SELECT '{name}' AS name, '{column}' AS column_name, COUNT(*) AS row_count, "
    f"ROUND(CAST(SUM({IN_SQL[kind].format(column)}) AS DOUBLE), 2) AS total FROM {name}"
    for name, columns in STAR_TABLES.items()
    for column, kind in columns.items()
)


def sums(table, name: str, columns: dict[str, str]):
    """One row per column: the number of rows and the sum of the column."""
    as_number = {
        "n": F.col,
        "d": lambda c: F.datediff(c, F.lit(date(1970, 1, 1))),
        "t": F.length,
        "b": lambda c: F.col(c).cast("int"),
    }
    totals = [F.round(F.sum(as_number[kind](c)).cast("double"), 2).alias(c) for c, kind in columns.items()]
    wide = table.agg(F.count(F.lit(1)).alias("row_count"), *totals)
    return wide.unpivot(["row_count"], list(columns), "column_name", "total").select(
        F.lit(name).alias("name"), "column_name", "row_count", "total"
    )


@check("full_refresh_star", STAR_SUMS)
def _(t):
    root = t.folder("refresh")
    refresh.refresh_period(t.spark, t.trips, t.zones, root, datetime(2024, 1, 1), datetime(2024, 2, 1))
    tables = [sums(t.spark.read.parquet(f"{root}/star/{n}"), n, c) for n, c in STAR_TABLES.items()]
    return reduce(DataFrame.unionAll, tables)


@check(
    "stream_hourly_demand",
    """SELECT "PULocationID" AS "LocationID", date_trunc('hour', tpep_pickup_datetime) AS pickup_hour,
    COUNT(*) AS demand FROM trips WHERE tpep_dropoff_datetime >= tpep_pickup_datetime GROUP BY 1, 2""",
)
def _(t):
    raw, log, checkpoint = t.folder("stream-raw"), t.folder("changes"), t.folder("checkpoint")
    # Newest trips first, a file for each batch, and a summary in between.
    year = F.year("tpep_pickup_datetime")
    for number, part in enumerate(["y >= 1997", "y between 1995 and 1996", "y < 1995 or y is null"]):
        t.trips.withColumn("y", year).where(part).drop("y").coalesce(1).write.parquet(f"{raw}/{number}")
        files = t.spark.readStream.schema(t.trips.schema).option("maxFilesPerTrigger", 1)
        trips = files.parquet(f"{raw}/*")
        write_hourly_changes(stream_hourly_demand(trips), log, checkpoint).awaitTermination()
        if number == 1:
            compact_hourly_changes(t.spark, log)
    return read_hourly_changes(t.spark, log)


@check(
    "month_run_ledger",
    """WITH m AS (SELECT date_trunc('month', pickup_hour) AS month, COUNT(*) AS row_count FROM monthly_demand GROUP BY 1),
    numbered AS (SELECT *, row_number() OVER (ORDER BY month DESC) AS back FROM m)
    SELECT strftime(month, '%Y-%m-%d') AS month, 'SUCCESS' AS status,
        CAST(CASE back WHEN 4 THEN 3 WHEN 2 THEN 2 ELSE 1 END AS INT) AS attempt, row_count,
        'month-' || strftime(month, '%Y-%m') AS source_file, CAST(NULL AS VARCHAR) AS error_message
    FROM numbered WHERE back <= 5""",
)
def _(t):
    """A backfill over the last five months that fails once, is killed twice, and each time goes on where it stopped."""
    root, now = t.folder("ledger"), [0.0]
    months = t.monthly_demand.select(F.trunc("pickup_hour", "month").alias("m")).distinct().orderBy(F.desc("m")).limit(5)
    last = sorted((r["m"].year, r["m"].month) for r in months.collect())
    runs = RunLedger(t.spark, f"{root}/log", lease=60, clock=lambda: now[0])

    def build(run):
        if run.month == last[1] and run.attempt == 1:
            raise OSError("the disk is full")
        span = (F.year("pickup_hour") == run.month[0]) & (F.month("pickup_hour") == run.month[1])
        path = f"{root}/demand/{run.month[0]}-{run.month[1]:02d}"
        w.sink_overwrite(t.monthly_demand.where(span), path)
        return t.spark.read.parquet(path).count()

    source = lambda month: f"month-{month[0]}-{month[1]:02d}"
    try:
        ingestion.run_backfill(runs, source, build, shift_month(*last[0], -1), last=last[-1])
    except OSError:
        runs.start(last[1], source(last[1]))  # the next runner is killed
    now[0] += 61
    ingestion.run_backfill(runs, source, build, shift_month(*last[0], -1), last=last[2])
    runs.start(last[3], source(last[3]))
    now[0] += 61
    ingestion.run_backfill(runs, source, build, shift_month(*last[0], -1), last=last[-1])
    return runs.state().select(F.col("month").cast("string").alias("month"), "status", "attempt", "row_count", "source_file", "error_message")


@check("stream_month_increment", "SELECT * FROM hourly")
def _(t):
    raw, root, checkpoint = t.folder("month-raw"), t.folder("months"), t.folder("checkpoint")
    t.trips.write.parquet(raw)
    stream_month_increment(
        t.spark, raw, t.trips.schema, t.zones, root, checkpoint, files_per_batch=1000
    ).awaitTermination()
    return t.spark.read.parquet(f"{root}/hourly_demand").drop("year", "month")


MONTH_TABLES = {
    "hourly_demand": ("hourly", {"LocationID": "n", "demand": "n"}),
    "features": ("features", {"LocationID": "n", "demand": "n", "lag_1h": "n", "lag_24h": "n"}),
    "business_trips": ("business", {"PULocationID": "n", "pickup_date": "d", "trip_distance": "n", "total_amount": "n"}),
    "zone_hour_daily": ("daily", {"LocationID": "n", "date": "d", "hour": "n", "weekday": "t", "demand": "n"}),
    "star/fact_demand": ("fact_demand", STAR_TABLES["fact_demand"]),
    "star/fact_trips": ("fact_trips", STAR_TABLES["fact_trips"]),
}
MONTH_SUMS = " UNION ALL ".join(
    f"SELECT '{name}' AS name, '{column}' AS column_name, COUNT(*) AS row_count, ROUND(CAST(SUM("
    + IN_SQL[kind].format(f'"{column}"') + f") AS DOUBLE), 2) AS total FROM {source}"
    for name, (source, columns) in MONTH_TABLES.items()
    for column, kind in columns.items()
)


@check("stream_month_datasets", MONTH_SUMS)
def _(t):
    raw, root, checkpoint = t.folder("month-raw"), t.folder("months"), t.folder("checkpoint")
    t.trips.write.parquet(raw)
    stream_month_increment(
        t.spark, raw, t.trips.schema, t.zones, root, checkpoint, files_per_batch=1000
    ).awaitTermination()
    tables = [sums(t.spark.read.parquet(f"{root}/{n}"), n, c) for n, (_, c) in MONTH_TABLES.items()]
    return reduce(DataFrame.unionAll, tables)


def updated_table(t, columns: list[str], update_columns=None) -> DataFrame:
    target, updates = upsert_sides(t)
    table = KeyedTable(t.spark, t.folder("keyed"), UPSERT_KEY, rows_per_file=1000)
    table.create(target)
    table.upsert(updates.select(columns), update_columns)
    return table.read()


@check("keyed_table_upsert", upsert_sql("n.demand, o.demand", "n.capacity, o.capacity"))
def _(t):
    return updated_table(t, [*UPSERT_KEY, "demand", "capacity"])


@check("keyed_table_some_columns", upsert_sql("n.demand, o.demand", "o.capacity"))
def _(t):
    return updated_table(t, [*UPSERT_KEY, "demand"])


@check("keyed_table_new_keys", upsert_sql("o.demand, n.demand", "o.capacity, n.capacity"))
def _(t):
    return updated_table(t, [*UPSERT_KEY, "demand", "capacity"], [])
