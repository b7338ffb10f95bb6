"""Results that must not depend on the session's time zone, on a size, or on a limit."""

import subprocess
import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hailgrid.functions.money import exact_sum
from hailgrid.operators.business import trip_metrics
from hailgrid.operators.demand import complete_grid, hourly_demand
from hailgrid.operators.profiling import duplicate_fares, duplicate_groups, quantile_table
from hailgrid.plans.demand_queries import top_zones
from tests.rows import demand_frame, frame, trip, zones_frame

# Clocks go forward on 9 March and back on 2 November 2025 in New York.
CLOCK_CHANGES = ["2025-03-09 01:30:00", "2025-03-09 02:30:00", "2025-03-09 03:10:00", "2025-11-02 00:59:00", "2025-11-02 01:30:00"]


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def test_hours_and_durations_have_no_zone(spark, zone):
    trips = frame(spark, *[trip(at, minutes=90) for at in CLOCK_CHANGES])
    hours = hourly_demand(trips).select(F.col("pickup_hour").cast("string").alias("h")).collect()
    assert sorted(r.h for r in hours) == sorted(at[:13] + ":00:00" for at in CLOCK_CHANGES)
    assert [r.duration_minutes for r in trip_metrics(trips).collect()] == [90.0] * 5
    grid = complete_grid(hourly_demand(trips), zones_frame(spark, 1), "2025-03-09 00:00:00", "2025-03-09 23:00:00")
    assert grid.count() == 24 and grid.agg({"demand": "sum"}).first()[0] == 3


def test_quantiles_are_exact_whatever_the_number_of_rows(spark):
    rows = spark.range(300_000).select(
        (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7 - 50_000).alias("spread"),
        F.when(F.col("id") % 3 == 0, 5.25).otherwise(F.col("id") % 100 - 20).cast("double").alias("hot"),
        F.lit(None).cast("double").alias("empty"),
    )
    levels = [0.0, 0.001, 0.5, 0.95, 0.9999, 1.0]
    got = quantile_table(rows, {c: F.col(c) for c in rows.columns}, levels)
    found = {(r.column_name, r.probability): r.quantile_value for r in got.collect()}
    assert "percentile" not in got._jdf.queryExecution().toString()
    values = rows.toPandas()
    for name in ("spread", "hot"):
        ordered = sorted(values[name])
        for p in levels:
            assert found[name, p] == ordered[max(1, -(-int(p * 10_000) * len(ordered) // 10_000)) - 1]
    assert len(found) == 12


def test_repeated_keys_with_many_fares(spark):
    # one key holds a third of the rows
    trips = frame(spark, *[trip(fare=float(i % 40)) for i in range(100)], *[trip(zone=2 + i) for i in range(200)])
    (group,) = duplicate_groups(trips).collect()
    assert group.records == 100 and group.fare_amounts == [float(i) for i in range(40)]
    assert duplicate_fares(trips).count() == 40


def test_limit_above_the_number_of_city_zones(spark):
    facts = spark.createDataFrame([(i, datetime(2024, 1, 1).date(), 1, i) for i in range(1000)], "location_id INT, pickup_date DATE, hour SMALLINT, demand BIGINT")
    zones = spark.createDataFrame([(i, "b", f"z{i}", "s") for i in range(1000)], "location_id INT, borough STRING, zone STRING, service_zone STRING")
    assert top_zones(facts, zones, 1000).count() == 1000
    with pytest.raises(ValueError):
        top_zones(facts, zones, 0)


def test_small_fractions_add_up(spark):
    rows = spark.range(100_000).select(F.lit(0.00004).alias("x"))
    assert float(rows.agg(exact_sum("x", digits=6)).first()[0]) == 4.0


def test_grid_of_part_days(spark):
    demand = demand_frame(spark, [(1, "2024-01-01 23:00:00", 4)])
    grid = complete_grid(demand, zones_frame(spark, 1, 2), "2024-01-01 22:00:00", "2024-01-02 01:00:00")
    assert sorted((r.LocationID, str(r.pickup_hour), r.demand) for r in grid.collect())[:2] == [
        (1, "2024-01-01 22:00:00", 0), (1, "2024-01-01 23:00:00", 4),
    ]
    assert grid.count() == 8


def test_entry_works_without_the_other_subpackage():
    code = """
import sys
sys.modules["hailgrid.llm"] = sys.modules["corpus_pipeline"] = None
import __spark_entry__ as entry
assert "top_zones" in entry.queries() and not any(x.startswith("op1_") or x == "pipeline" for x in entry.queries())
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1])
