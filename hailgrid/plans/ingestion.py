"""Processing months by the run ledger: one month, the next one, or a backfill that resumes where it stopped.

``source`` names the raw file of a month, or gives None while it is not there. ``build`` does the work of a run;
it is given the run, may renew it, and returns how many rows it has written. Builds replace whole months, so a
month that is taken up again after a lost run is right whatever that run left behind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailgrid.functions.calendar import month_span, shift_month
from hailgrid.plans.refresh import has_month, rebuild_month, rebuild_month_features, stored_months
from hailgrid.sinks.commits import path_exists
from hailgrid.streaming.ledger import Month, Run, RunLedger

Source = Callable[[Month], str | None]
Build = Callable[[Run], int]


def files_by_month(spark: SparkSession, pattern: str) -> Source:
    """Raw files named by month, as in ``/raw/trips_{year}-{month:02d}.parquet``."""

    def find(month: Month) -> str | None:
        path = pattern.format(year=month[0], month=month[1])
        return path if path_exists(spark, path) else None

    return find


def trip_build(spark: SparkSession, zones: DataFrame, root: str, ledger: RunLedger) -> Build:
    """Rebuild all datasets of a run's month from its file, and the features of the stored month after it."""

    def build(run: Run) -> int:
        trips = spark.read.parquet(run.source_file)
        rebuild_month(spark, trips, zones, root, *run.month)
        ledger.renew(run)
        following = shift_month(*run.month, 1)
        if has_month(spark, root, *following):
            rebuild_month_features(spark, zones, root, *following)
        return stored_months(spark, f"{root}/clean_trips", run.month).count()

    return build


def process_month(ledger: RunLedger, month: Month, source: Source, build: Build) -> bool:
    """Run one month; False if its file is not there. A failure is recorded and raised again."""
    file = source(month)
    if file is None:
        return False
    run = ledger.start(month, file)
    try:
        rows = build(run)
    except Exception as error:
        try:
            ledger.fail(run, str(error))
        except Exception as second:  # noqa: BLE001 - the first error is the one to see
            error.add_note(f"the failure could not be recorded: {second}")
        raise
    ledger.succeed(run, rows)
    return True


def run_next_month(ledger: RunLedger, source: Source, build: Build, baseline: Month) -> tuple[Month, bool]:
    """Process the month after the last success, if its file is there; that month, and whether it was processed."""
    month = ledger.next_month(baseline)
    return month, process_month(ledger, month, source, build)


def run_backfill(
    ledger: RunLedger, source: Source, build: Build, baseline: Month, first: Month | None = None, last: Month | None = None
) -> list[Month]:
    """Process month after month up to ``last`` (inclusive), or to the first month without a file.

    It starts at ``first``, but never before the month after the last success, so calling it again after a failure
    or a kill goes on where it stopped.
    """
    for bound in (first, last):
        if bound is not None:
            month_span(*bound)  # refuses months outside 1 to 12
    month, done = ledger.next_month(baseline), []
    if first is not None:
        month = max(first, month)
    while (last is None or month <= last) and process_month(ledger, month, source, build):
        done.append(month)
        month = shift_month(*month, 1)
    return done


def ledger_report(ledger: RunLedger) -> DataFrame:
    """The state of all months, in order."""
    return ledger.state().orderBy(F.col("month"))
