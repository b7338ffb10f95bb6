"""Features over slices of time, and samples that can be drawn again."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hailgrid.operators import sampling
from hailgrid.operators.demand import complete_grid
from hailgrid.operators.history import demand_features, in_slices, sliced_demand_features
from tests.rows import demand_frame, zones_frame


@pytest.fixture(scope="module")
def grid(spark):
    start = datetime(2024, 1, 1)
    rows = [(z, str(start + timedelta(hours=h)), (h * 7 + z) % 23) for z in (1, 2) for h in range(0, 1200, z)]
    return complete_grid(demand_frame(spark, rows), zones_frame(spark, 1, 2, 3), "2024-01-01 00:00:00", "2024-02-19 23:00:00").cache()


@pytest.mark.parametrize("hours", [168, 200, 24 * 90])
def test_slices_equal_plain_windows(grid, hours):
    plain, sliced = demand_features(grid), sliced_demand_features(grid, hours)
    assert sliced.columns == plain.columns
    assert plain.exceptAll(sliced).count() == sliced.exceptAll(plain).count() == 0


def test_no_partition_holds_the_history_of_a_zone(grid):
    sizes = in_slices(grid, 200).groupBy("LocationID", "slice").count()
    assert sizes.agg(F.max("count")).first()[0] <= 200 + 168
    with pytest.raises(ValueError):
        in_slices(grid, 100)


ROWS = [(i % 50, i / 7, None if i % 3 else "x") for i in range(2000)] + [(1, 2.5, "same")] * 500


def test_a_sample_does_not_depend_on_partitions(spark):
    rows = spark.createDataFrame(ROWS, "a INT, b DOUBLE, n STRING")
    draws = [sorted(map(str, sampling.keyed_sample(rows.repartition(p), 0.2, seed=5).collect())) for p in (1, 3, 11)]
    assert draws[0] == draws[1] == draws[2]
    assert 350 < len(draws[0]) < 650
    copies = sum("same" in row for row in draws[0])
    assert 60 < copies < 140  # copies are drawn one by one
    assert sorted(map(str, sampling.keyed_sample(rows, 0.2, seed=6).collect())) != draws[0]


def test_a_larger_sample_holds_the_smaller_one(spark):
    rows = spark.createDataFrame(ROWS, "a INT, b DOUBLE, n STRING")
    small, large = sampling.keyed_sample(rows, 0.1), sampling.keyed_sample(rows, 0.3)
    assert small.exceptAll(large).count() == 0 < large.exceptAll(small).count()
    assert sampling.keyed_sample(rows, 0).count() == 0 and sampling.keyed_sample(rows, 1).count() == len(ROWS)
    with pytest.raises(ValueError):
        sampling.keyed_sample(rows, 1.5)


def test_blocks_of_copies_give_the_same_sample(spark, monkeypatch):
    rows = spark.createDataFrame(ROWS, "a INT, b DOUBLE, n STRING")
    plain = sorted(map(str, sampling.keyed_sample(rows, 0.2).collect()))
    monkeypatch.setattr(sampling, "COPIES_AT_ONCE", 16)
    assert sorted(map(str, sampling.keyed_sample(rows, 0.2).collect())) == plain
