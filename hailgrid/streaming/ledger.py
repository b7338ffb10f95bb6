"""The run ledger of months: who works on which month, what has been done, and what comes next.

Every change of state is a commit of one log, so it is decided by compare-and-swap: two runners can't both take a
month, and a run that has lost its month can't report on it. A month is RUNNING, SUCCESS or FAILED; a month that
is run again starts as RUNNING with the next attempt. A run holds its month for a lease, which it may renew; after
that a killed run counts as lost and the month may be taken up by another one.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailgrid.functions.calendar import shift_month
from hailgrid.sinks.commits import Conflict, commit, history

RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
#: Characters of an error message that are kept.
MESSAGE_LENGTH = 4000
#: Seconds a run holds its month without renewing.
LEASE = 6 * 3600
_ATTEMPTS = 50
EVENT = (
    "month DATE, status STRING, run STRING, source_file STRING, attempt INT, started_at DOUBLE, at DOUBLE, "
    "until DOUBLE, error_message STRING, row_count BIGINT"
)

Month = tuple[int, int]


class MonthBusy(RuntimeError):
    """Another run holds the month."""


class RunLost(RuntimeError):
    """The month has been taken up by another run."""


@dataclass(frozen=True)
class Run:
    month: Month
    source_file: str
    id: str
    attempt: int
    started_at: float


class RunLedger:
    """The ledger in ``folder``. ``clock`` gives seconds since 1970; runners' clocks should agree to the lease."""

    def __init__(self, spark: SparkSession, folder: str, lease: float = LEASE, clock: Callable[[], float] = time.time):
        self.spark, self.folder, self.lease, self.clock = spark, folder, lease, clock

    def events(self) -> DataFrame:
        return history(self.spark, self.folder, EVENT)

    def state(self) -> DataFrame:
        """One row per month: its last status, run, attempt, source, times and error."""
        last = self.events().groupBy("month").agg(F.max_by(F.struct("*"), "version").alias("e"))
        finished = F.when(F.col("e.status") != RUNNING, F.timestamp_seconds("e.at"))
        return last.select(
            "month", "e.source_file", "e.status", "e.run", "e.attempt", F.timestamp_seconds("e.started_at").alias("started_at"),
            finished.alias("completed_at"), "e.error_message", "e.row_count",
        )

    def last_success(self, baseline: Month) -> Month:
        """The latest month whose last run succeeded, or the baseline."""
        found = self.state().where(F.col("status") == SUCCESS).agg(F.max("month")).first()[0]
        return (found.year, found.month) if found else baseline

    def next_month(self, baseline: Month) -> Month:
        return shift_month(*self.last_success(baseline), 1)

    def start(self, month: Month, source_file: str) -> Run:
        """Take a month, or raise ``MonthBusy`` while another run holds it."""
        run = Run(month, source_file, uuid.uuid4().hex, 1, 0.0)
        for _ in range(_ATTEMPTS):
            version, last = self._look(month)
            now = self.clock()
            if last and last["status"] == RUNNING and last["until"] > now:
                held = datetime.fromtimestamp(last["until"], timezone.utc)
                raise MonthBusy(f"{month[0]}-{month[1]:02d} is held by run {last['run']} until {held:%Y-%m-%d %H:%M:%S} UTC")
            run = replace(run, attempt=(last["attempt"] if last else 0) + 1, started_at=now)
            if self._commit(version, run, RUNNING, now):
                return run
        raise Conflict(f"{self.folder} is written too often by others")

    def renew(self, run: Run) -> None:
        """Hold the month for another lease from now on."""
        self._own(run, RUNNING)

    def succeed(self, run: Run, row_count: int | None = None) -> None:
        self._own(run, SUCCESS, row_count=row_count)

    def fail(self, run: Run, message: str) -> None:
        self._own(run, FAILED, error_message=message[:MESSAGE_LENGTH])

    def _own(self, run: Run, status: str, **more) -> None:
        for _ in range(_ATTEMPTS):
            version, last = self._look(run.month)
            if not last or last["run"] != run.id or last["status"] != RUNNING:
                raise RunLost(f"run {run.id} no longer holds {run.month[0]}-{run.month[1]:02d}")
            if self._commit(version, run, status, self.clock(), **more):
                return
        raise Conflict(f"{self.folder} is written too often by others")

    def _look(self, month: Month):
        """The number of the last commit, and the last event of a month: read together."""
        own = F.when(F.col("month") == F.lit(date(*month, 1)), F.col("version"))
        row = self.events().agg(F.max("version").alias("v"), F.max_by(F.struct("*"), own).alias("e"), F.max(own).alias("own")).first()
        return row["v"] or 0, row["e"] if row["own"] is not None else None

    def _commit(self, version: int, run: Run, status: str, now: float, **more) -> bool:
        event = {
            "month": f"{run.month[0]}-{run.month[1]:02d}-01", "status": status, "run": run.id, "source_file": run.source_file,
            "attempt": run.attempt, "started_at": run.started_at, "at": now, "until": now + self.lease, **more,
        }
        try:
            commit(self.spark, self.folder, version, event)
            return True
        except Conflict:
            return False
