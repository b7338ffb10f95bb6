"""Profiles that are kept up to date against full builds."""

import itertools

import pytest

from hailgrid.operators.profile_store import (
    State,
    build_profiles,
    stored_expanding_profiles,
    stored_full_profiles,
    stored_partials,
    update_profiles,
)
from hailgrid.operators.profiles import expanding_profiles, full_profiles, month_partials
from hailgrid.sinks.commits import Conflict, commit
from tests.rows import demand_frame

MONTHS = {
    (2024, 1): [(1, "2024-01-01 08:00:00", 3), (1, "2024-01-08 08:00:00", 6), (2, "2024-01-02 09:00:00", 1)],
    (2024, 2): [(1, "2024-02-05 08:00:00", 10), (3, "2024-02-06 23:00:00", 4)],
    (2024, 4): [(1, "2024-04-01 08:00:00", 8), (2, "2024-04-02 09:00:00", 5), (2, "2024-04-03 10:00:00", 0)],
}


def rows(frame):
    return sorted(map(str, frame.collect()))


def agrees(spark, root, months):
    demand = demand_frame(spark, [row for m in months.values() for row in m])
    assert rows(stored_partials(spark, root)) == rows(month_partials(demand))
    assert rows(stored_expanding_profiles(spark, root)) == rows(expanding_profiles(demand))
    assert rows(stored_full_profiles(spark, root)) == rows(full_profiles(demand))


@pytest.mark.parametrize("order", list(itertools.permutations(MONTHS)))
def test_months_in_any_order(spark, tmp_path, order):
    known = {}
    for month in order:
        known[month] = MONTHS[month]
        update_profiles(demand_frame(spark, MONTHS[month]), str(tmp_path), *month)
    agrees(spark, str(tmp_path), known)


def test_rebuilt_and_emptied_months_are_retracted(spark, tmp_path):
    root, months = str(tmp_path), dict(MONTHS)
    build_profiles(demand_frame(spark, [row for m in months.values() for row in m]), root)
    agrees(spark, root, months)
    months[2024, 1] = [(1, "2024-01-01 08:00:00", 5), (4, "2024-01-03 01:00:00", 2)]  # a slot goes, one comes
    update_profiles(demand_frame(spark, [r for m in months.values() for r in m]), root, 2024, 1)
    agrees(spark, root, months)
    months[2024, 1] = []
    update_profiles(demand_frame(spark, [(9, "2030-01-01 00:00:00", 1)]), root, 2024, 1)
    agrees(spark, root, months)
    months[2023, 12] = [(3, "2023-12-05 23:00:00", 7)]
    update_profiles(demand_frame(spark, months[2023, 12]), root, 2023, 12)
    agrees(spark, root, months)


def test_repeated_updates_change_nothing_and_other_months_are_not_read(spark, tmp_path):
    root = str(tmp_path)
    build_profiles(demand_frame(spark, MONTHS[2024, 1] + MONTHS[2024, 2]), root)
    before = State(spark, root)
    for _ in range(2):
        update_profiles(demand_frame(spark, MONTHS[2024, 2]), root, 2024, 2)
    agrees(spark, root, {m: MONTHS[m] for m in list(MONTHS)[:2]})
    assert State(spark, root).months["2024-01-01"] == before.months["2024-01-01"]  # the same files


def test_an_update_from_an_old_state_is_refused(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    build_profiles(demand_frame(spark, MONTHS[2024, 1]), root)
    old = State(spark, root)
    update_profiles(demand_frame(spark, MONTHS[2024, 2]), root, 2024, 2)
    monkeypatch.setattr("hailgrid.operators.profile_store.State", lambda *_: old)
    with pytest.raises(Conflict):
        update_profiles(demand_frame(spark, MONTHS[2024, 4]), root, 2024, 4)
    monkeypatch.undo()
    agrees(spark, root, {m: MONTHS[m] for m in list(MONTHS)[:2]})
    with pytest.raises(Conflict):
        commit(spark, f"{root}/log", 1, {})


def test_an_empty_store(spark, tmp_path):
    root = str(tmp_path)
    assert stored_full_profiles(spark, root).count() == stored_expanding_profiles(spark, root).count() == 0
    build_profiles(demand_frame(spark, []), root)
    agrees(spark, root, {(2024, 1): []})
