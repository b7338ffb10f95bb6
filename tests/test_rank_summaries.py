"""Merged summaries against exact ranks."""

import math
import random
from bisect import bisect_left, bisect_right
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hailgrid.functions.storage import new_folder
from hailgrid.operators import rank_summaries as r

LEVELS = [0.0, 0.001, 0.1, 0.5, 0.9, 0.999, 1.0]


def made(spark, n=20_000):
    """Three months; a third of all values are equal, some are empty, no number, or negative."""
    draw = random.Random(4)
    kinds = [lambda: 7.25, lambda: draw.lognormvariate(2, 1), lambda: draw.choice([None, math.nan, -1.5, 0.0, -0.0, 3.0])]
    rows = [(datetime(2024, 1, 1) + timedelta(minutes=draw.randrange(131_000)), kinds[i % 3]()) for i in range(n)]
    rows += [(None, 5.0)]
    return rows, spark.createDataFrame(rows, "at TIMESTAMP_NTZ, value DOUBLE")


@pytest.mark.parametrize("parts, unit", [(1, "month"), (40, "month"), (1000, "month"), (10, "day"), (10**6, "day")])
def test_ranks_are_within_the_stated_error(spark, parts, unit):
    rows, given = made(spark)
    known = sorted(v for at, v in rows if at and v is not None and not math.isnan(v))
    kept = r.period_summaries(given, "at", {"value": F.col("value")}, unit, parts).cache()
    assert kept.groupBy("period").count().agg(F.max("count")).first()[0] <= 2 * parts + 1
    for row in r.span_quantiles(kept, LEVELS).collect():
        wanted = max(1, math.ceil(row.probability * len(known)))
        first, last = bisect_left(known, row.quantile_value) + 1, bisect_right(known, row.quantile_value)
        assert row.known_rows == len(known) and row.rank_error <= len(known) / parts
        assert last >= wanted and first <= wanted + row.rank_error
        if parts == 10**6:
            assert row.rank_error == 0 and known[wanted - 1] == row.quantile_value
    for row in r.span_rows_upto(kept, [-2.0, 0.0, 7.25, 9.0, 1e9]).collect():
        assert row.least_rows <= bisect_right(known, row.upto) <= row.most_rows


def test_months_in_any_order_and_again(spark):
    _, given = made(spark, 6000)
    month = F.month("at")
    parts = {m: r.period_summaries(given.where(month == m), "at", {"value": F.col("value")}, parts=30) for m in (1, 2, 3)}
    whole = r.period_summaries(given, "at", {"value": F.col("value")}, parts=30)
    stores = []
    for order in ((1, 2, 3), (3, 1, 2, 3)):
        root = new_folder(spark, "summaries")
        for m in order:
            r.store_summaries(parts[m], root)
        stores.append(spark.read.parquet(root).select(whole.columns))
    for stored in stores:
        assert stored.exceptAll(whole).count() == whole.exceptAll(stored).count() == 0
    r.store_summaries(parts[2].where("false"), root, (2024, 2))
    left = spark.read.schema(f"period DATE, column_name STRING, value DOUBLE, weight LONG, step LONG").parquet(root)
    assert left.where("month(period) = 2").count() == 0 < left.count()


def test_nothing_known_and_bad_arguments(spark):
    empty = spark.createDataFrame([(datetime(2024, 1, 1), None)], "at TIMESTAMP_NTZ, value DOUBLE")
    kept = r.period_summaries(empty, "at", {"value": F.col("value")})
    assert kept.count() == r.span_quantiles(kept, LEVELS).count() == r.span_rows_upto(kept, [1.0]).count() == 0
    for bad in ({"unit": "week"}, {"parts": 0}):
        with pytest.raises(ValueError):
            r.period_summaries(empty, "at", {"value": F.col("value")}, **bad)


def test_values_are_counted_in_wanted_buckets_only(spark, monkeypatch):
    """Leaving out the other buckets before values are counted changes nothing."""
    _, given = made(spark, 6000)
    make = lambda: r.period_summaries(given, "at", {"value": F.col("value")}, parts=20)
    few = make()
    assert "LeftSemi" in few._jdf.queryExecution().optimizedPlan().toString()
    rows = sorted(few.collect())
    monkeypatch.setattr(r, "BROADCAST_BUCKETS", 0)
    whole = make()
    assert "LeftSemi" not in whole._jdf.queryExecution().optimizedPlan().toString()
    assert rows and rows == sorted(whole.collect())
