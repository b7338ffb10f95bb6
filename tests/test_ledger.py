"""Numbered commits, published versions and the run ledger, with several writers."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from hailgrid.plans.ingestion import files_by_month, process_month, run_backfill, run_next_month, trip_build
from hailgrid.sinks.commits import Conflict, commit, history, latest
from hailgrid.sinks.snapshots import current_version, expire, read_snapshot, snapshot_replace, versions
from hailgrid.streaming.ledger import MonthBusy, RunLedger, RunLost
from tests.rows import frame, trip, zones_frame

BASE = (2024, 1)


@pytest.fixture
def clock():
    class Clock:
        now = 1_000_000.0

        def __call__(self):
            return self.now

    return Clock()


@pytest.fixture
def ledger(spark, tmp_path, clock):
    return RunLedger(spark, str(tmp_path / "ledger"), lease=60, clock=clock)


def states(ledger):
    return {(r.month.year, r.month.month): (r.status, r.attempt) for r in ledger.state().collect()}


def test_one_of_many_writers_makes_a_commit(spark, tmp_path):
    folder = str(tmp_path / "log")

    def attempt(i):
        try:
            return commit(spark, folder, 0, {"writer": i})
        except Conflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(attempt, range(24)))
    assert sorted(x for x in made if x) == [1]
    (row,) = history(spark, folder, "writer INT").collect()
    assert (row.version, row.writer) == (1, made.index(1)) and latest(spark, folder) == 1
    assert [p.name for p in (tmp_path / "log").iterdir()] == ["000000000001.json"]
    with pytest.raises(Conflict):
        commit(spark, folder, 0, {"writer": 99})
    assert commit(spark, folder, 1, {"writer": 99}) == 2


def test_an_empty_log(spark, tmp_path):
    assert latest(spark, str(tmp_path / "none")) == 0
    assert history(spark, str(tmp_path / "none"), "x INT").count() == 0


def test_a_month_goes_from_running_to_success(ledger):
    run = ledger.start((2024, 2), "february")
    assert states(ledger) == {(2024, 2): ("RUNNING", 1)}
    assert ledger.last_success(BASE) == BASE and ledger.next_month(BASE) == (2024, 2)
    ledger.succeed(run, 7)
    row = ledger.state().first()
    assert (row.status, row.row_count, row.source_file) == ("SUCCESS", 7, "february") and row.completed_at
    assert ledger.next_month(BASE) == (2024, 3)


def test_a_month_never_runs_twice_at_once(ledger, clock):
    ledger.start((2024, 2), "f")
    with pytest.raises(MonthBusy):
        ledger.start((2024, 2), "f")
    ledger.start((2024, 3), "g")  # another month is free
    clock.now += 59
    with pytest.raises(MonthBusy):
        ledger.start((2024, 2), "f")


def test_of_many_runners_one_gets_the_month(spark, tmp_path):
    folder = str(tmp_path / "ledger")

    def take(_):
        try:
            return RunLedger(spark, folder).start((2024, 2), "f")
        except MonthBusy:
            return None

    with ThreadPoolExecutor(6) as pool:
        runs = [run for run in pool.map(take, range(6)) if run]
    assert len(runs) == 1 and states(RunLedger(spark, folder)) == {(2024, 2): ("RUNNING", 1)}


def test_a_killed_run_is_taken_up_and_can_no_longer_report(ledger, clock):
    lost = ledger.start((2024, 2), "f")
    clock.now += 61
    second = ledger.start((2024, 2), "f")
    assert second.attempt == 2
    for report in (lambda: ledger.succeed(lost), lambda: ledger.fail(lost, "x"), lambda: ledger.renew(lost)):
        with pytest.raises(RunLost):
            report()
    ledger.succeed(second)
    with pytest.raises(RunLost):
        ledger.fail(second, "too late")
    assert states(ledger) == {(2024, 2): ("SUCCESS", 2)}


def test_a_renewed_run_keeps_its_month(ledger, clock):
    run = ledger.start((2024, 2), "f")
    for _ in range(3):
        clock.now += 50
        ledger.renew(run)
    with pytest.raises(MonthBusy):
        ledger.start((2024, 2), "f")
    ledger.succeed(run)


def test_failures_are_kept_and_raised(ledger):
    def broken(run):
        raise OSError("x" * 5000)

    with pytest.raises(OSError):
        process_month(ledger, (2024, 2), lambda m: "f", broken)
    row = ledger.state().first()
    assert row.status == "FAILED" and len(row.error_message) == 4000
    assert ledger.next_month(BASE) == (2024, 2)  # it is next again


def test_backfill_resumes_after_failure_and_kill(ledger, clock):
    built = []

    def build(run):
        if run.month == (2024, 4) and run.attempt == 1:
            raise RuntimeError("no disk")
        built.append(run.month)
        return len(built)

    source = lambda month: f"file-{month}" if month <= (2024, 6) else None
    with pytest.raises(RuntimeError, match="no disk"):
        run_backfill(ledger, source, build, BASE)
    assert built == [(2024, 2), (2024, 3)]
    ledger.start((2024, 4), "killed")  # a runner that dies without a word
    with pytest.raises(MonthBusy):
        run_backfill(ledger, source, build, BASE)
    clock.now += 61
    assert run_backfill(ledger, source, build, BASE, last=(2024, 5)) == [(2024, 4), (2024, 5)]
    assert run_next_month(ledger, source, build, BASE) == ((2024, 6), True)
    assert run_next_month(ledger, source, build, BASE) == ((2024, 7), False)
    assert run_backfill(ledger, source, build, BASE, first=(2023, 5)) == []  # never before the last success
    assert states(ledger) == {
        (2024, 2): ("SUCCESS", 1), (2024, 3): ("SUCCESS", 1), (2024, 4): ("SUCCESS", 3), (2024, 5): ("SUCCESS", 1),
        (2024, 6): ("SUCCESS", 1),
    }
    with pytest.raises(ValueError):
        run_backfill(ledger, source, build, BASE, last=(2024, 13))


def test_backfill_of_trip_files(spark, tmp_path, ledger):
    raw, root = tmp_path / "raw", str(tmp_path / "out")
    for month in (1, 2):
        frame(spark, trip(f"2024-0{month}-10 08:00:00"), trip(f"2024-0{month}-11 09:00:00", zone=2)).write.parquet(f"{raw}/t_2024-0{month}")
    source = files_by_month(spark, f"{raw}/t_{{year}}-{{month:02d}}")
    build = trip_build(spark, zones_frame(spark, 1, 2), root, ledger)
    assert run_backfill(ledger, source, build, (2023, 12)) == [(2024, 1), (2024, 2)]
    assert {r.row_count for r in ledger.state().collect()} == {2}
    facts = spark.read.parquet(f"{root}/star/fact_demand")
    assert facts.agg(F.sum("demand")).first()[0] == 4


def test_of_two_publishers_one_wins(spark, tmp_path):
    root = str(tmp_path)
    one, two = spark.range(3), spark.range(5)
    assert snapshot_replace(spark, root, {"a": one, "b": one}, expected=0) == 1
    seen = current_version(spark, root)
    assert snapshot_replace(spark, root, {"a": two, "b": two}, expected=seen) == 2
    with pytest.raises(Conflict):
        snapshot_replace(spark, root, {"a": one, "b": one}, expected=seen)
    assert (read_snapshot(spark, root, "a").count(), read_snapshot(spark, root, "b").count()) == (5, 5)
    assert read_snapshot(spark, root, "a", version=1).count() == 3


def test_readers_never_see_a_mixture(spark, tmp_path):
    root = str(tmp_path)

    def publish(n):
        return snapshot_replace(spark, root, {"a": spark.range(n), "b": spark.range(n)})

    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(publish, range(1, 7)))
    assert sorted(numbers) == list(range(1, 7))
    for number in numbers:
        sizes = {read_snapshot(spark, root, name, number).count() for name in ("a", "b")}
        assert len(sizes) == 1
    assert versions(spark, root).count() == 6


def test_old_and_refused_versions_expire(spark, tmp_path):
    root = str(tmp_path)
    for n in (1, 2, 3):
        snapshot_replace(spark, root, {"a": spark.range(n)})
    spark.range(9).write.parquet(f"{root}/versions/refused/a")
    assert expire(spark, root, keep=2) == 2
    assert [read_snapshot(spark, root, "a", v).count() for v in (2, 3)] == [2, 3]
    for version in (1, 4):
        with pytest.raises(RuntimeError):
            read_snapshot(spark, root, "a", version)
    with pytest.raises(ValueError):
        expire(spark, root, 0)
