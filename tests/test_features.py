import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hailgrid.fixed import FUTURE_FEATURES
from hailgrid.functions.calendar import with_future_calendar
from hailgrid.operators.demand import complete_grid
from hailgrid.operators.history import demand_features, month_features, month_grid_with_history
from hailgrid.operators.profiles import (
    expanding_profiles,
    full_profiles,
    future_scoring_grid,
    historical_profile_features,
)
from tests.rows import demand_frame, zones_frame


def test_future_calendar_of_a_sunday_evening(spark):
    row = with_future_calendar(demand_frame(spark, [(1, "2026-09-06 18:00:00", 10)])).first()
    assert (row["hour"], row["day_of_week"], row["month"], row["is_weekend"]) == (18, 1, 9, 1)
    assert row["hour_sin"] == pytest.approx(math.sin(2 * math.pi * 18 / 24))
    assert row["hour_cos"] == pytest.approx(math.cos(2 * math.pi * 18 / 24))


def test_future_features_know_nothing_about_the_target():
    assert not {"demand", "lag_1h", "lag_24h", "lag_168h", "rolling_mean_24h"} & set(FUTURE_FEATURES)
    assert len(FUTURE_FEATURES) == 13


def test_scoring_grid_covers_every_slot(spark):
    demand = demand_frame(spark, [(1, "2026-01-01 00:00:00", 2), (2, "2026-01-01 00:00:00", 3)])
    grid = future_scoring_grid(demand)
    assert grid.count() == 2 * 12 * 7 * 24
    for column, values in (("month", 12), ("day_of_week", 7), ("hour", 24)):
        assert grid.select(column).distinct().count() == values
    assert grid.where("zone_dow_hour_mean IS NOT NULL").count() == 2 * 12
    assert grid.where("zone_mean_demand IS NULL").count() == 0


def test_grid_is_complete_and_keeps_the_total(spark):
    demand = demand_frame(spark, [(1, "2024-01-01 01:00:00", 4), (2, "2024-01-02 23:00:00", 5), (9, "2024-01-01 00:00:00", 7)])
    grid = complete_grid(demand, zones_frame(spark, 1, 2, 3), "2024-01-01 00:00:00", "2024-01-02 23:00:00")
    assert grid.count() == 3 * 48
    assert grid.agg(F.sum("demand")).first()[0] == 9
    assert grid.where("demand > 0").count() == 2


def test_lags_and_rolling_exclude_the_current_hour(spark):
    hours = [(1, str(datetime(2024, 1, 1 + h // 24, h % 24)), h + 1) for h in range(200)]
    grid = complete_grid(demand_frame(spark, hours), zones_frame(spark, 1), "2024-01-01 00:00:00", "2024-01-09 07:00:00")
    rows = demand_features(grid).orderBy("pickup_hour").collect()
    assert [r["lag_1h"] for r in rows[:2]] == [None, 1]
    assert rows[23]["lag_24h"] is None and rows[24]["lag_24h"] == 1
    assert rows[167]["lag_168h"] is None and rows[168]["lag_168h"] == 1
    assert rows[0]["rolling_mean_24h"] is None and rows[0]["history_count_24h"] == 0
    assert rows[30]["rolling_mean_24h"] == pytest.approx(sum(range(7, 31)) / 24)
    assert max(r["history_count_168h"] for r in rows) == 168


def test_month_looks_back_only_when_the_month_before_has_demand(spark):
    zones = zones_frame(spark, 1)
    with_before = demand_frame(spark, [(1, "2024-01-31 23:00:00", 6), (1, "2024-02-01 00:00:00", 2)])
    features = month_features(with_before, zones, 2024, 2)
    assert features.count() == 29 * 24
    first = features.orderBy("pickup_hour").first()
    assert (first["lag_1h"], first["history_count_168h"]) == (6, 168)
    alone = with_before.where("demand = 2")
    assert month_grid_with_history(alone, zones, 2024, 2).count() == 29 * 24
    assert month_features(alone, zones, 2024, 2).orderBy("pickup_hour").first()["lag_1h"] is None


DEMAND = [
    (1, "2024-01-01 05:00:00", 4),  # Monday
    (1, "2024-01-08 05:00:00", 6),
    (1, "2024-01-02 06:00:00", 1),
    (1, "2024-02-05 05:00:00", 10),
    (1, "2024-04-01 05:00:00", 7),  # March is missing
    (2, "2024-02-05 05:00:00", 3),
]


def test_profiles_use_strictly_earlier_months(spark):
    rows = {
        (r["LocationID"], r["pickup_hour"].month, r["hour"]): r
        for r in historical_profile_features(demand_frame(spark, DEMAND)).collect()
    }
    assert rows[1, 1, 5]["zone_mean_demand"] is None
    february = rows[1, 2, 5]
    assert february["zone_mean_demand"] == pytest.approx(11 / 3)
    assert february["zone_hour_mean"] == pytest.approx(5)
    assert february["zone_dow_hour_mean"] == pytest.approx(5)
    april = rows[1, 4, 5]
    assert april["zone_mean_demand"] == pytest.approx(21 / 4)
    assert april["zone_dow_hour_mean"] == pytest.approx(20 / 3)
    assert rows[2, 2, 5]["zone_mean_demand"] is None


def test_profiles_match_brute_force(spark):
    """Means over earlier months, recomputed row by row in Python."""
    data = [
        (z, str(datetime(2024, m, d, h)), (z * 7 + m * 5 + d * 3 + h) % 11)
        for z in (1, 2)
        for m in range(1, 6)
        for d in range(1, 29, 1 + m % 3)
        for h in (0, 7, 13)
    ]
    demand = demand_frame(spark, data)
    parsed = [(z, datetime.fromisoformat(t), v) for z, t, v in data]

    def mean(values):
        return sum(values) / len(values) if values else None

    for r in expanding_profiles(demand).collect():
        month = r["calendar_month"].month
        earlier = [(t, v) for z, t, v in parsed if z == r["LocationID"] and t.month < month]
        same_hour = [(t, v) for t, v in earlier if t.hour == r["hour"]]
        same_slot = [v for t, v in same_hour if t.isoweekday() % 7 + 1 == r["day_of_week"]]
        for name, expected in (
            ("zone_mean_demand", mean([v for _, v in earlier])),
            ("zone_hour_mean", mean([v for _, v in same_hour])),
            ("zone_dow_hour_mean", mean(same_slot)),
        ):
            assert (r[name] is None) == (expected is None)
            assert expected is None or r[name] == pytest.approx(expected)


def test_full_profiles_keep_wider_means_for_unseen_slots(spark):
    profile = full_profiles(demand_frame(spark, DEMAND))
    assert profile.count() == 2 * 168
    unseen = profile.where("LocationID = 1 AND day_of_week = 7 AND hour = 5").first()
    assert unseen["zone_dow_hour_mean"] is None
    assert unseen["zone_hour_mean"] == pytest.approx(27 / 4)
