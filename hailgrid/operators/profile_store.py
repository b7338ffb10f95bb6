"""Profiles kept up to date month by month: incremental maintenance of stored sums.

The store holds, for every month with demand, its *partials* (sum and count per zone, weekday and hour) and its
*history* (the same sums over all strictly earlier months), and the *totals* over all months. A new or rebuilt
month is compared with its stored partials: the difference is added to the totals and to the histories of later
months, which retracts what the month had counted before. Demand of other months is not read again. Sums are whole
numbers, so any order of additions and retractions ends with the sums of a full build.

Files are never changed. A commit (``hailgrid.sinks.commits``) names the files of the current state, so readers see
a state whole, and of two updates that start from the same state one is refused and has to start again.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hailgrid.operators.profiles import GRAINS, MONTH_SLOT_KEYS, SLOT_KEYS, month_partials, profiles_of_partials
from hailgrid.sinks.commits import commit, history

SUMS = ["demand_sum", "demand_count"]
ROWS = "LocationID INT, day_of_week INT, hour INT, demand_sum BIGINT, demand_count BIGINT"
STATE = "totals STRING, months ARRAY<STRUCT<month: STRING, partials: STRING, history: STRING>>"


class State:
    """The current version and its files: paths below the store, or None where there are no rows."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        log = history(spark, f"{root}/log", STATE)
        row = log.orderBy(F.desc("version")).limit(1).first()
        self.version = row["version"] if row else 0
        self.totals = row["totals"] if row else None
        self.months = {m["month"]: (m["partials"], m["history"]) for m in row["months"]} if row else {}

    def read(self, path: str | None) -> DataFrame:
        if path is None:
            return self.spark.createDataFrame([], ROWS)
        return self.spark.read.schema(ROWS).parquet(f"{self.root}/{path}")

    def all(self, kind: int) -> DataFrame:
        """The partials (0) or histories (1) of all months, with ``calendar_month``."""
        paths = [f"{self.root}/{paths[kind]}" for paths in self.months.values() if paths[kind]]
        if not paths:
            return self.spark.createDataFrame([], f"calendar_month DATE, {ROWS}")
        return self.spark.read.schema(f"calendar_month DATE, {ROWS}").parquet(*paths)


def _added(*parts: DataFrame) -> DataFrame:
    """Sums of several tables per slot; slots that are left without observations go."""
    whole = parts[0].select(*SLOT_KEYS, *SUMS)
    for part in parts[1:]:
        whole = whole.unionByName(part.select(*SLOT_KEYS, *SUMS))
    added = whole.groupBy(*SLOT_KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
    return added.where("demand_count <> 0 OR demand_sum <> 0")


def _write_by_month(rows: DataFrame, root: str, folder: str) -> None:
    """One folder per month; the month stays in the rows as well."""
    named = rows.withColumn("m", F.date_format("calendar_month", "yyyy-MM-dd"))
    named.hint("rebalance", "m").write.partitionBy("m").parquet(f"{root}/{folder}")


def _commit(state: State, months: dict[str, tuple[str, str | None]], totals: str) -> int:
    listed = [{"month": m, "partials": paths[0], "history": paths[1]} for m, paths in sorted(months.items())]
    return commit(state.spark, f"{state.root}/log", state.version, {"totals": totals, "months": listed})


def build_profiles(demand: DataFrame, root: str) -> int:
    """Replace the store's state by a full build over ``demand``; returns the version."""
    spark, state, folder = demand.sparkSession, State(demand.sparkSession, root), uuid.uuid4().hex
    _write_by_month(month_partials(demand), root, f"{folder}/partials")
    partials = spark.read.schema(f"calendar_month DATE, {ROWS}, m STRING").parquet(f"{root}/{folder}/partials")
    months = [f"{row[0]:%Y-%m-%d}" for row in partials.select("calendar_month").distinct().orderBy("calendar_month").collect()]
    if not months:
        _added(state.read(None)).write.parquet(f"{root}/{folder}/totals")
        return _commit(state, {}, f"{folder}/totals")
    # Every slot at every month, so that a history also has the slots its own month lacks.
    every = partials.select(*SLOT_KEYS).distinct().withColumn("calendar_month", F.explode(F.array(*[F.lit(date.fromisoformat(m)) for m in months])))
    before = Window.partitionBy(*SLOT_KEYS).orderBy("calendar_month").rowsBetween(Window.unboundedPreceding, -1)
    running = every.join(partials.drop("m"), MONTH_SLOT_KEYS, "left").withColumns({c: F.sum(c).over(before) for c in SUMS})
    _write_by_month(running.where("demand_count IS NOT NULL"), root, f"{folder}/history")
    _added(partials).write.parquet(f"{root}/{folder}/totals")
    paths = {m: (f"{folder}/partials/m={m}", f"{folder}/history/m={m}" if m != months[0] else None) for m in months}
    return _commit(state, paths, f"{folder}/totals")


def update_profiles(demand: DataFrame, root: str, year: int, month: int) -> int:
    """Bring one month up to date with ``demand``, of which only that month is read; returns the version.

    A month that has lost all its demand leaves the store. Raises ``Conflict`` if another update came first.
    """
    spark, state, folder = demand.sparkSession, State(demand.sparkSession, root), uuid.uuid4().hex
    name, at = f"{year}-{month:02d}-01", F.lit(date(year, month, 1))
    rows = demand.where((F.year("pickup_hour") == year) & (F.month("pickup_hour") == month))
    with_month = lambda table: table.withColumn("calendar_month", at).select(*MONTH_SLOT_KEYS, *SUMS)
    month_partials(rows).write.parquet(f"{root}/{folder}/partials")
    new = spark.read.parquet(f"{root}/{folder}/partials")
    old = state.read(state.months.get(name, (None,))[0])
    change = _added(new, old.withColumns({c: -F.col(c) for c in SUMS}))
    change.write.parquet(f"{root}/{folder}/change")
    change = spark.read.schema(ROWS).parquet(f"{root}/{folder}/change")
    _added(state.read(state.totals), change).write.parquet(f"{root}/{folder}/totals")

    months = dict(state.months)
    if new.isEmpty():
        months.pop(name, None)
    else:
        own = months[name][1] if name in months else _history_of_new(state, name, folder, with_month)
        months[name] = (f"{folder}/partials", own)
    later = [m for m in sorted(state.months) if m > name]
    if later and not change.isEmpty():
        shifted = change.withColumn("calendar_month", F.explode(F.array(*[F.lit(date.fromisoformat(m)) for m in later])))
        known = state.all(1).where(F.col("calendar_month") > at)
        both = known.unionByName(shifted.select(*known.columns)).groupBy(*MONTH_SLOT_KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        _write_by_month(both.where("demand_count <> 0 OR demand_sum <> 0"), root, f"{folder}/history")
        written = spark.read.schema("calendar_month DATE").parquet(f"{root}/{folder}/history").distinct().collect()
        left = {f"{row[0]:%Y-%m-%d}" for row in written}  # one row per month
        for m in later:
            months[m] = (months[m][0], f"{folder}/history/m={m}" if m in left else None)
    return _commit(state, months, f"{folder}/totals")


def _history_of_new(state: State, name: str, folder: str, with_month) -> str | None:
    """The history of a month that is not stored yet: that of the month before it, and that month's partials."""
    earlier = [m for m in sorted(state.months) if m < name]
    if not earlier:
        return None
    partials, before = state.months[earlier[-1]]
    path = f"{folder}/own-history"
    with_month(_added(state.read(partials), state.read(before))).write.parquet(f"{state.root}/{path}")
    return path


def stored_partials(spark: SparkSession, root: str) -> DataFrame:
    """``month_partials`` of the current state."""
    return State(spark, root).all(0).select(*MONTH_SLOT_KEYS, *SUMS)


def stored_expanding_profiles(spark: SparkSession, root: str) -> DataFrame:
    """``expanding_profiles`` of the current state: means over strictly earlier months."""
    state = State(spark, root)
    own = state.all(0).select(*MONTH_SLOT_KEYS, *[F.lit(0).cast("long").alias(c) for c in SUMS], F.lit(True).alias("own"))
    before = state.all(1).select(*MONTH_SLOT_KEYS, *SUMS, F.lit(False).alias("own"))
    slots = own.unionByName(before).groupBy(*MONTH_SLOT_KEYS).agg(*[F.sum(c).alias(c) for c in SUMS], F.max("own").alias("own"))
    means = {}
    for name, keys in GRAINS.items():
        window = Window.partitionBy("calendar_month", *keys)
        means[name] = F.try_divide(F.sum("demand_sum").over(window), F.nullif(F.sum("demand_count").over(window), F.lit(0)))
    return slots.withColumns(means).where("own").select(*MONTH_SLOT_KEYS, *GRAINS)


def stored_full_profiles(spark: SparkSession, root: str) -> DataFrame:
    """``full_profiles`` of the current state."""
    state = State(spark, root)
    return profiles_of_partials(state.read(state.totals))
