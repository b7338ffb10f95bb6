from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hailgrid.functions.calendar import month_span, shift_month
from hailgrid.operators.business import business_from_clean, business_predicate, trip_metrics
from hailgrid.operators.cleaning import FILTER_WORDS, clean_trips, correction_groups, drop_reversals, parted
from hailgrid.operators.demand import clean_hourly_demand, hourly_demand
from tests.rows import frame, trip

JANUARY = (datetime(2024, 1, 1), datetime(2024, 2, 1))


def fares(rows):
    return sorted(r["fare_amount"] for r in rows.collect())


def test_month_bounds_roll_over_the_year():
    assert month_span(2024, 12) == (datetime(2024, 12, 1), datetime(2025, 1, 1))
    assert shift_month(2024, 1, -1) == (2023, 12)
    assert shift_month(2024, 12, 1) == (2025, 1)
    with pytest.raises(ValueError):
        month_span(2024, 13)


def test_window_is_half_open_and_chronology_is_checked(spark):
    trips = frame(
        spark,
        trip("2024-01-01 00:00:00", fare=1.0),
        trip("2024-02-01 00:00:00", fare=2.0),
        trip("2023-12-31 23:59:59", fare=3.0),
        trip("2024-01-05 10:00:00", minutes=-1, fare=4.0),
        trip("2024-01-05 10:00:00", minutes=0, fare=5.0),
    )
    assert fares(clean_trips(trips, *JANUARY)) == [1.0, 5.0]


REVERSALS = [
    trip(fare=10.0),  # charged back below
    trip(fare=-10.0),
    trip(fare=10.0),  # exact copy of a reversed trip goes too
    trip(zone=3, fare=-5.0),  # a lone negative fare stays
    trip(zone=4, fare=7.0),
    trip(zone=4, fare=7.0),  # copies without a reversal stay
    trip(zone=5, to=None, fare=9.0),  # an incomplete key never identifies a reversal
    trip(zone=5, to=None, fare=-9.0),
    trip(zone=6, fare=0.0),  # zero counts as not negative
    trip(zone=6, fare=-1.0),
    trip(zone=7, fare=None),  # an empty fare shares the fate of its key
    trip(zone=7, fare=2.0),
    trip(zone=7, fare=-2.0),
    trip(zone=8, fare=None),
]


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_reversals(spark, limit):
    kept = drop_reversals(frame(spark, *REVERSALS), limit)
    left = sorted((r["PULocationID"], r["fare_amount"]) for r in kept.fillna(99.0, ["fare_amount"]).collect())
    assert left == [(3, -5.0), (4, 7.0), (4, 7.0), (5, -9.0), (5, 9.0), (8, 99.0)]


def test_correction_groups_treat_empty_fields_as_equal(spark):
    groups = correction_groups(frame(spark, *REVERSALS))
    found = sorted((r["PULocationID"], r["records"], r["min_fare"], r["max_fare"]) for r in groups.collect())
    assert found == [(1, 3, -10.0, 10.0), (5, 2, -9.0, 9.0), (6, 2, -1.0, 0.0), (7, 3, -2.0, 2.0)]


def test_demand_by_key_equals_counting_clean_trips(spark):
    trips = frame(spark, *REVERSALS)
    expected = sorted(map(tuple, hourly_demand(clean_trips(trips, *JANUARY)).collect()))
    for limit in (0, 1_000_000):
        assert sorted(map(tuple, clean_hourly_demand(trips, *JANUARY, limit).collect())) == expected


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    """A third of all rows are copies of one reversed trip; every row of it must go."""
    other = frame(spark, *[trip(zone=z, fare=float(z)) for z in range(10, 30)])
    hot = frame(spark, trip(fare=10.0)).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(5000)))).drop("n")
    trips = other.unionByName(hot).unionByName(frame(spark, trip(fare=-10.0)))
    assert drop_reversals(trips, 0).count() == 20
    assert clean_hourly_demand(trips, *JANUARY, 0).agg(F.sum("demand")).first()[0] == 20


def test_business_rules_keep_unknown_ratios(spark):
    trips = frame(
        spark,
        trip(zone=1, miles=0.0),  # no fare per mile
        trip(zone=2, minutes=0),  # no speed
        trip(zone=3, minutes=1, miles=2.0),  # 120 mph
        trip(zone=4, miles=0.05, fare=10.0),  # 200 per mile
        trip(zone=5, pay=0),
        trip(zone=6, pay=6),
        trip(zone=7, pay=None),
        trip(zone=8, fare=-1.0),
        trip(zone=9, total=-1.0),
    )
    assert {r["PULocationID"] for r in business_predicate(trips).collect()} == {1, 2, 3, 4}
    kept = business_from_clean(trips)
    assert {r["PULocationID"] for r in kept.collect()} == {1, 2}
    row = kept.where("PULocationID = 1").first()
    assert (row["pickup_hour"], row["weekday_number"], row["pickup_month"]) == (8, 3, 1)
    ratios = trip_metrics(trips).where("PULocationID = 3").first()
    assert ratios["speed_mph"] == pytest.approx(120) and ratios["fare_per_mile"] == pytest.approx(5)


def test_time_bounds_reach_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "trips")
    frame(spark, trip()).write.parquet(path)
    clean_trips(spark.read.parquet(path), *JANUARY).explain("formatted")
    pushed = [line for line in capsys.readouterr().out.splitlines() if "PushedFilters" in line]
    assert pushed
    for line in pushed:
        assert "GreaterThanOrEqual(tpep_pickup_datetime" in line
        assert "LessThan(tpep_pickup_datetime" in line


def test_the_filter_never_loses_a_suspect_and_its_mistakes_change_nothing(spark):
    rows = [trip(zone=z, fare=float(sign * (1 + z))) for z in range(300) for sign in ([1, -1] if z % 10 == 0 else [1])]
    trips = frame(spark, *rows)
    exact = {z for z in range(300) if z % 10}
    for words in (1, 3, 64, FILTER_WORDS):
        clear, suspects = parted(trips, words)
        found = {r["PULocationID"] for r in suspects.collect()}
        assert found >= {z for z in range(0, 300, 10)}
        assert clear.count() + suspects.count() == len(rows)
        assert {r["PULocationID"] for r in drop_reversals(trips, words).collect()} == exact
    assert found == {z for z in range(0, 300, 10)}  # the full size makes no mistake on so few keys
    assert parted(trips, 1)[1].count() > 60  # one word does


def test_no_job_runs_before_an_action(spark):
    trips, jobs = frame(spark, *REVERSALS), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    clean_trips(trips, *JANUARY)
    clean_hourly_demand(trips, *JANUARY)
    correction_groups(trips)
    assert list(jobs.getJobIdsForGroup("building")) == []
    spark.sparkContext.setJobGroup("tests", "")


def test_a_hot_reversed_key_is_removed_without_a_shuffle_of_its_rows(spark):
    """A key with a third of the rows is matched by a broadcast; its rows are in no shuffled join."""
    other = [trip(zone=z, fare=float(sign)) for z in range(2, 1500) for sign in (1, -1)]
    hot = frame(spark, trip(fare=10.0)).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(1500)))).drop("n")
    trips = frame(spark, *other, trip(zone=5000)).unionByName(hot).unionByName(frame(spark, trip(fare=-10.0)))
    kept = drop_reversals(trips)
    assert [r["PULocationID"] for r in kept.collect()] == [5000]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "rightHint=(strategy=broadcast)" in plan
