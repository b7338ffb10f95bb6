from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hailgrid.fixed import PROFILE_MODEL
from hailgrid.models.evaluation import model_leaderboard, select_production_model, winner_name
from hailgrid.operators.business import business_from_clean
from hailgrid.operators.star import dim_date, dim_hour, dim_payment, dim_zone, fact_trips
from hailgrid.operators.upsert import upsert_by_key
from hailgrid.plans import demand_queries as d
from hailgrid.plans import forecast_queries as f
from hailgrid.plans import revenue_queries as r
from tests.rows import frame, trip, zones_frame


@pytest.fixture(scope="module")
def facts(spark):
    trips = frame(
        spark,
        trip(zone=1, pay=1, fare=10.0, miles=3.0, tip_amount=2.0),
        trip(zone=1, pay=1, fare=20.0, miles=4.0, tip_amount=4.0),
        trip(zone=2, pay=2, fare=30.0, miles=1.0, tip_amount=0.0),
        trip(zone=2, pay=2, fare=0.1, miles=0.0, tip_amount=0.0),
        trip(zone=2, pay=2, fare=0.2, miles=0.0, tip_amount=0.0),
    )
    return fact_trips(business_from_clean(trips))


def test_fact_sums_are_exact(facts):
    row = facts.where("location_id = 2").first()
    assert str(row["fare_amount"]) == "30.30" and row["trip_count"] == 3


def test_revenue_questions(spark, facts):
    zones = dim_zone(zones_frame(spark, 1, 2))
    summary = r.business_summary(facts).first()
    assert (summary["total_trips"], summary["total_fare_amount"]) == (5, 60.3)
    assert summary["avg_trip_distance"] == 1.6
    tips = r.tip_analysis(facts).first()
    assert (tips["total_tips"], tips["avg_tip_per_trip"], tips["tip_to_fare_pct"]) == (6.0, 3.0, 20.0)
    mix = {x["payment_method"]: x["trip_share_pct"] for x in r.payment_breakdown(facts, dim_payment(spark)).collect()}
    assert mix == {"Cash": 60.0, "Credit card": 40.0}
    assert r.credit_card_share(r.payment_breakdown(facts, dim_payment(spark))).first()[0] == 40.0
    assert [x["Zone"] for x in r.revenue_by_zone(facts, zones).collect()] == ["Zone 2", "Zone 1"]
    assert [x["Zone"] for x in r.airport_zones(facts, zones).collect()] == ["Zone 1"]
    bands = {x["distance_band"]: x["total_trips"] for x in r.trip_distance_bands(facts).collect()}
    assert bands == {"0-2 miles": 3, "5-10 miles": 2}  # the summed distance of a fact row decides


def test_ratios_are_empty_without_trips(facts):
    tips = r.tip_analysis(facts.where("location_id = 99")).first()
    assert tips["avg_tip_per_trip"] is None and tips["tip_to_fare_pct"] is None


def test_limits_and_dates_are_checked(spark, facts):
    zones = dim_zone(zones_frame(spark, 1, 2))
    for limit in (0, -1):
        with pytest.raises(ValueError):
            r.revenue_by_zone(facts, zones, limit)
    # A caller that wants no more rows than there are zones says so.
    for ranked in (r.revenue_by_zone, r.tip_analysis_by_zone):
        assert ranked(facts, zones, 265, at_most=265).count() > 0
        with pytest.raises(ValueError):
            ranked(facts, zones, 266, at_most=265)
    with pytest.raises(ValueError):
        d.optional_dates(facts, "pickup_date", date(2024, 2, 1), date(2024, 1, 1))


def test_ties_go_to_the_earlier_row(spark):
    rows = [(1, date(2024, 1, day), 0, n) for day, n in ((1, 3), (2, 5), (3, 5))]
    facts = spark.createDataFrame(rows, "location_id INT, pickup_date DATE, hour SMALLINT, demand BIGINT")
    kpis = d.zone_kpis(facts, 1).first()
    assert (kpis["total_demand"], kpis["peak_daily_demand"], kpis["peak_date"]) == (13, 5, date(2024, 1, 2))
    hours = spark.createDataFrame([(3, 2.0), (1, 2.0), (2, 1.0), (0, 1.0)], "hour INT, avg_demand DOUBLE")
    days = spark.createDataFrame(
        [(2, "Tuesday", 9.0), (1, "Monday", 9.0)], "weekday_number INT, weekday STRING, avg_demand DOUBLE"
    )
    insight = d.demand_insights(hours, days).first()
    assert (insight["peak_hour"], insight["low_hour"], insight["peak_weekday"]) == (1, 0, "Monday")
    assert insight["peak_vs_average_pct"] == pytest.approx(100 / 3, abs=1e-3)


def test_resampling_fills_missing_days(spark):
    daily = spark.createDataFrame([(date(2024, 2, 28), 2), (date(2024, 3, 2), 5)], "pickup_hour DATE, total_demand BIGINT")
    assert [x["total_demand"] for x in d.daily_resample(daily).collect()] == [2, 0, 0, 5]


def test_dimensions(spark):
    dates = dim_date(spark.createDataFrame([(date(2024, 1, 7),), (date(2024, 1, 8),)], "date DATE")).collect()
    assert [(x["weekday_number"], x["weekday"], x["is_weekend"]) for x in dates] == [
        (7, "Sunday", True),
        (1, "Monday", False),
    ]
    parts = {x["hour"]: x["day_part"] for x in dim_hour(spark).collect()}
    assert [parts[h] for h in (0, 5, 6, 11, 12, 17, 18, 23)] == [
        "Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening",
    ]
    twice = zones_frame(spark, 1, 2).unionByName(zones_frame(spark, 1, 1))
    assert dim_zone(twice).count() == 2


def test_upsert_modes(spark):
    ddl = "id INT, a STRING, b STRING"
    target = spark.createDataFrame([(1, "a1", "b1"), (2, "a2", None)], ddl)
    updates = spark.createDataFrame([(2, None, "n2"), (3, "n3", "n3")], ddl)

    def merged(columns=None):
        return sorted(map(tuple, upsert_by_key(target, updates, ["id"], columns).collect()))

    assert merged() == [(1, "a1", "b1"), (2, None, "n2"), (3, "n3", "n3")]
    assert merged(["b"]) == [(1, "a1", "b1"), (2, "a2", "n2"), (3, "n3", "n3")]
    assert merged([]) == [(1, "a1", "b1"), (2, "a2", None), (3, "n3", "n3")]
    with pytest.raises(ValueError):
        merged(["c"])


METRICS = "model STRING, mae DOUBLE, rmse DOUBLE"


def test_model_choice(spark):
    first = spark.createDataFrame(
        [("random_forest", 7.1, 18.9), (PROFILE_MODEL, 6.4, 16.0), ("linear_regression", 7.0, 16.4)], METRICS
    )
    assert winner_name(first) == PROFILE_MODEL
    tie = spark.createDataFrame([("a", 5.0, 12.0), ("b", 5.0, 11.0)], METRICS)
    assert select_production_model(tie).first()["model"] == "b"
    assert [x["status"] for x in model_leaderboard(tie).collect()] == ["Production", "Candidate"]
    with pytest.raises(ValueError):
        winner_name(tie.limit(0))


def test_forecast_fallbacks(spark):
    rows = [(1, 1, 2, 8, 10.0), (1, 1, 3, 8, 20.0), (1, 2, 2, 8, 60.0), (1, 1, 2, 9, 2.0)]
    profile = spark.createDataFrame(rows, "location_id INT, month INT, day_of_week INT, hour INT, predicted_demand DOUBLE")
    cut = F.expr("TIMESTAMP_NTZ '2024-01-01 08:00:00'")

    def ask(zone, text):
        asked = spark.createDataFrame([(zone, datetime.fromisoformat(text))], "location_id INT, forecast_datetime TIMESTAMP_NTZ")
        found = f.forecast_lookup_batch(asked, profile, cut, PROFILE_MODEL).first()
        return found and (found["predicted_demand"], found["forecast_method"])

    assert ask(1, "2024-01-08 08:30:00") == (10.0, PROFILE_MODEL)  # a Monday
    assert ask(1, "2024-01-11 08:00:00") == (15.0, "month_hour_fallback")
    assert ask(1, "2024-05-11 08:00:00") == (30.0, "hour_fallback")
    assert ask(1, "2024-05-11 17:00:00") == (23.0, "zone_fallback")
    assert ask(2, "2024-05-11 17:00:00") is None
    assert ask(1, "2024-01-01 08:00:00") is None  # not after the cut-off
    lookup = f.future_profile_lookup(profile, 1, month=1, day_of_week=2, hour=8).first()
    assert tuple(lookup) == (4, 10.0, 15.0, 30.0, 23.0)
    old = f.future_profile_lookup(profile.where("month = 1").drop("month"), 1, 1, 2, 8).first()
    assert (old["exact_demand"], old["month_hour_demand"], old["hour_demand"]) == (10.0, None, 15.0)


def test_zoned_forecast_times_are_read_on_new_york_clocks(spark):
    rows = [(1, 7, 1, h, float(h)) for h in range(24)]
    profile = spark.createDataFrame(rows, "location_id INT, month INT, day_of_week INT, hour INT, predicted_demand DOUBLE")
    asked = spark.sql("SELECT 1 AS location_id, TIMESTAMP '2024-07-07 12:00:00Z' AS forecast_datetime")
    cut = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")
    assert f.forecast_lookup_batch(asked, profile, cut, PROFILE_MODEL).first()["predicted_demand"] == 8.0
