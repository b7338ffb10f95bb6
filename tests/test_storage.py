from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hailgrid.operators.cleaning import clean_trips
from hailgrid.operators.demand import hourly_demand
from hailgrid.plans.refresh import rebuild_month, refresh_period
from hailgrid.sinks.snapshots import read_snapshot, snapshot_replace
from hailgrid.sinks.writers import sink_metrics_csv, sink_months
from hailgrid.sources.contract import contract_report, validate_trip_schema
from hailgrid.sources.readers import (
    scan_metrics_csv,
    scan_trips,
    scan_trips_month,
    scan_trips_range,
    scan_zone_lookup,
)
from hailgrid.streaming.hourly import (
    compact_hourly_changes,
    read_hourly_changes,
    stream_hourly_demand,
    write_hourly_changes,
)
from hailgrid.streaming.months import stream_month_increment, touched_months
from tests.rows import SCHEMA, demand_frame, frame, trip, zones_frame


def test_contract(spark):
    trips = frame(spark, trip())
    report = validate_trip_schema(trips.withColumn("surprise", F.lit(1)).withColumn("extra", F.lit(0.5)))
    assert report["new_columns"] == ["surprise"] and "extra" not in report["missing_optional"]
    with pytest.raises(ValueError, match="fare_amount"):
        validate_trip_schema(trips.drop("fare_amount"))
    text = trips.withColumn("fare_amount", F.col("fare_amount").cast("string"))
    with pytest.raises(TypeError, match="fare_amount"):
        validate_trip_schema(text)
    bad = {r["column_name"]: r["status"] for r in contract_report(text.drop("VendorID")).collect()}
    assert (bad["fare_amount"], bad["VendorID"], bad["extra"]) == ("incompatible", "missing", "missing")


def test_month_files(spark, tmp_path):
    root = str(tmp_path)
    for month in (1, 2):
        frame(spark, trip(f"2025-0{month}-10 08:00:00")).write.parquet(f"{root}/yellow_tripdata_2025-0{month}.parquet")
    assert scan_trips_month(spark, root, 2025, 2).count() == 1
    assert scan_trips_range(spark, root, 2025).count() == 2
    files = [f"{root}/yellow_tripdata_2025-0{m}.parquet" for m in (1, 2)]
    assert scan_trips(spark, *files, year=2025, month=1).count() == 1
    with pytest.raises(ValueError):
        scan_trips(spark, *files, year=2025)
    with pytest.raises(ValueError):
        scan_trips_month(spark, root, 2025, 13)
    with pytest.raises(Exception, match="2025-03"):
        scan_trips_month(spark, root, 2025, 3)


def test_zone_lookup_keeps_the_text_na(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, Airport",EWR\n264,Unknown,N/A,N/A\n')
    rows = scan_zone_lookup(spark, str(path)).orderBy("LocationID").collect()
    assert rows[0]["Zone"] == "Newark, Airport" and rows[1]["service_zone"] == "N/A"


def test_month_sink_replaces_one_month_only(spark, tmp_path):
    root = str(tmp_path / "demand")
    sink_months(demand_frame(spark, [(1, "2024-01-31 23:00:00", 1), (1, "2024-02-01 00:00:00", 2)]), root, "pickup_hour")
    for _ in range(2):
        sink_months(demand_frame(spark, [(2, "2024-02-03 00:00:00", 5)]), root, "pickup_hour")
    stored = spark.read.parquet(root)
    assert sorted((r["LocationID"], r["month"], r["demand"]) for r in stored.collect()) == [(1, 1, 1), (2, 2, 5)]
    sink_months(demand_frame(spark, [(3, "2024-03-03 00:00:00", 7)]), root, "pickup_hour", replace_all=True)
    assert spark.read.parquet(root).count() == 1


def test_snapshot_shows_only_complete_versions(spark, tmp_path):
    root = str(tmp_path)
    one = spark.range(3).withColumnRenamed("id", "x")
    snapshot_replace(spark, root, {"a": one, "b": one})
    broken = one.select(F.raise_error(F.lit("stop")).alias("x"))
    with pytest.raises(Exception, match="stop"):
        snapshot_replace(spark, root, {"a": one.limit(1), "b": broken})
    assert read_snapshot(spark, root, "a").count() == 3
    snapshot_replace(spark, root, {"a": one.limit(2), "b": one})
    assert read_snapshot(spark, root, "a").count() == 2


def test_metric_files_are_checked(spark, tmp_path):
    path = str(tmp_path / "m")
    sink_metrics_csv(spark.createDataFrame([("a", 1.0, 2.0)], "model STRING, mae DOUBLE, rmse DOUBLE"), path)
    assert scan_metrics_csv(spark, path, "historical_metrics").first()["rmse"] == 2.0
    with pytest.raises(RuntimeError):
        scan_metrics_csv(spark, path, "future_summary")
    empty = str(tmp_path / "e")
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "part.csv").write_text("model,mae,rmse\n")
    with pytest.raises(RuntimeError, match="empty"):
        scan_metrics_csv(spark, empty, "historical_metrics")


RAW = [
    trip("2024-01-30 08:00:00", zone=1),
    trip("2024-01-31 23:10:00", zone=1),
    trip("2024-01-31 23:20:00", zone=2, fare=4.0),
    trip("2024-01-31 23:20:00", zone=2, fare=-4.0),
    trip("2024-02-01 00:30:00", zone=1),
    trip("2024-02-10 12:00:00", zone=2),
]


def table(spark, root, name):
    rows = spark.read.parquet(f"{root}/{name}")
    return sorted(map(str, rows.select(*sorted(rows.columns)).collect()))


DATASETS = ["hourly_demand", "business_trips", "zone_hour_daily", "star/fact_demand", "star/fact_trips", "star/dim_date", "star/dim_zone"]


def test_month_by_month_equals_full_refresh(spark, tmp_path):
    trips, zones = frame(spark, *RAW), zones_frame(spark, 1, 2)
    whole, steps = str(tmp_path / "whole"), str(tmp_path / "steps")
    refresh_period(spark, trips, zones, whole, datetime(2024, 1, 1), datetime(2024, 3, 1))
    for month in (1, 2, 2):  # repeating a month changes nothing
        rebuild_month(spark, trips, zones, steps, 2024, month)
    for name in DATASETS:
        assert table(spark, whole, name) == table(spark, steps, name), name
    lag = "LocationID = 1 AND pickup_hour = TIMESTAMP_NTZ '2024-02-01 00:00:00'"
    for root in (whole, steps):
        first = spark.read.parquet(f"{root}/features").where(lag).first()
        assert (first["lag_1h"], first["demand"]) == (1, 1)


def test_late_file_rebuilds_its_month_and_the_next_lags(spark, tmp_path):
    raw, root, checkpoint = (str(tmp_path / n) for n in ("raw", "out", "checkpoint"))
    zones = zones_frame(spark, 1, 2)

    def run():
        query = stream_month_increment(spark, raw, SCHEMA, zones, root, checkpoint, first=(2024, 1))
        query.awaitTermination()

    frame(spark, *RAW).coalesce(1).write.parquet(f"{raw}/a")
    frame(spark, trip("2003-01-01 00:00:00")).coalesce(1).write.parquet(f"{raw}/stray")
    raw = f"{raw}/*"
    run()
    late = frame(spark, trip("2024-01-31 23:50:00", zone=1), trip("2024-01-31 23:59:00", zone=1, fare=3.0))
    late.coalesce(1).write.parquet(str(tmp_path / "raw" / "b"))
    run()
    everything = spark.read.schema(SCHEMA).parquet(raw)
    bounds = datetime(2024, 1, 1), datetime(2024, 3, 1)
    expected = hourly_demand(clean_trips(everything, *bounds)).collect()
    stored = spark.read.parquet(f"{root}/hourly_demand").drop("year", "month").collect()
    assert sorted(map(tuple, stored)) == sorted(map(tuple, expected))
    first = spark.read.parquet(f"{root}/features").where(
        "LocationID = 1 AND pickup_hour = TIMESTAMP_NTZ '2024-02-01 00:00:00'"
    ).first()
    assert first["lag_1h"] == 3
    assert touched_months(everything) == [(2003, 1), (2024, 1), (2024, 2)]
    assert touched_months(everything, first=(2024, 1), last=(2024, 1)) == [(2024, 1)]


def test_stream_equals_batch_and_restart_counts_once(spark, tmp_path):
    raw, log, checkpoint = (str(tmp_path / n) for n in ("raw", "log", "checkpoint"))
    parts = [RAW[:2], RAW[2:5], RAW[5:]]

    def run():
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{raw}/*")
        write_hourly_changes(stream_hourly_demand(source), log, checkpoint).awaitTermination()

    for number, part in enumerate(parts):
        frame(spark, *part).coalesce(1).write.parquet(f"{raw}/{number}")
        run()
    run()  # nothing new
    expected = hourly_demand(frame(spark, *RAW)).collect()
    found = read_hourly_changes(spark, log).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, expected))


def test_stream_counts_files_in_any_order(spark, tmp_path):
    raw, log, checkpoint = (str(tmp_path / n) for n in ("raw", "log", "checkpoint"))
    files = [RAW[5:], RAW[2:5], RAW[:2], [trip("2003-01-09 12:00:00", zone=3)]]
    for number, rows in enumerate(files):
        frame(spark, *rows).coalesce(1).write.parquet(f"{raw}/{number}")
        source = spark.readStream.schema(SCHEMA).parquet(f"{raw}/*")
        write_hourly_changes(stream_hourly_demand(source), log, checkpoint).awaitTermination()
        if number:
            compact_hourly_changes(spark, log)
            compact_hourly_changes(spark, log)  # nothing new
    expected = hourly_demand(frame(spark, *[x for rows in files for x in rows])).collect()
    assert sorted(map(tuple, read_hourly_changes(spark, log).collect())) == sorted(map(tuple, expected))


def test_a_month_without_trips_replaces_what_was_stored(spark, tmp_path):
    root, zones = str(tmp_path / "out"), zones_frame(spark, 1, 2)
    trips = frame(spark, *RAW)
    for month in (1, 2):
        rebuild_month(spark, trips, zones, root, 2024, month)
    rebuild_month(spark, trips.where("false"), zones, root, 2024, 1)
    of = lambda name, m: spark.read.parquet(f"{root}/{name}").where(f"year = 2024 AND month = {m}")
    for name in ("hourly_demand", "business_trips", "star/fact_trips"):
        assert of(name, 1).isEmpty() and not of(name, 2).isEmpty(), name
    for name in ("features", "zone_hour_daily", "star/fact_demand"):  # the grid stays, without demand
        assert of(name, 1).agg({"demand": "sum"}).first()[0] == 0, name
        assert of(name, 2).agg({"demand": "sum"}).first()[0] > 0, name
