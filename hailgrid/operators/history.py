"""Lag and rolling features over the complete zone-hour grid.

Frames count rows, and on the complete grid a row is an hour. All features share one window
specification, so Spark sorts once. A zone's history need not be one partition: it is cut into slices
of time, and each slice gets the hours before it that its first rows look back to.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hailgrid.fixed import HISTORY_HOURS, LAG_HOURS, ROLLING_HOURS
from hailgrid.functions.calendar import (
    between_moments,
    month_span,
    shift_month,
    with_time_features,
)
from hailgrid.operators.demand import complete_grid


#: Hours of a slice; with the hours before it a partition has 2,328 rows.
SLICE_HOURS = 90 * 24


def by_zone() -> WindowSpec:
    return Window.partitionBy("LocationID").orderBy("pickup_hour")


def by_slice() -> WindowSpec:
    return Window.partitionBy("LocationID", "slice").orderBy("pickup_hour")


def in_slices(grid: DataFrame, hours: int = SLICE_HOURS) -> DataFrame:
    """The rows of a complete grid by slices of time; the last 168 hours of a slice also open the next one.

    ``slice`` is where a row is put, ``own_slice`` where it belongs. ``without_halo`` drops the repeated rows.
    """
    if hours < HISTORY_HOURS:
        raise ValueError(f"a slice must have {HISTORY_HOURS} hours at least")
    hour = F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ '1970-01-01 00:00:00', cast(pickup_hour AS TIMESTAMP_NTZ))")
    own = F.floor(hour / hours)
    opens_next = F.pmod(hour, F.lit(hours)) >= hours - HISTORY_HOURS
    own_and_next = F.when(opens_next, F.array("own_slice", F.col("own_slice") + 1)).otherwise(F.array("own_slice"))
    return grid.withColumn("own_slice", own).withColumn("slice", F.explode(own_and_next))


def without_halo(rows: DataFrame) -> DataFrame:
    return rows.where("slice = own_slice").drop("slice", "own_slice")


def with_lags(grid: DataFrame, window: WindowSpec | None = None) -> DataFrame:
    """Demand 1, 24 and 168 hours earlier in the same zone."""
    window = window or by_zone()
    return grid.withColumns({f"lag_{n}h": F.lag("demand", n).over(window) for n in LAG_HOURS})


def with_rolling(grid: DataFrame, window: WindowSpec | None = None) -> DataFrame:
    """Mean and row count of the previous 24 and 168 hours, without the current hour."""
    columns = {}
    for n in ROLLING_HOURS:
        before = (window or by_zone()).rowsBetween(-n, -1)
        columns[f"rolling_mean_{n}h"] = F.avg("demand").over(before)
        columns[f"history_count_{n}h"] = F.count("demand").over(before)
    return grid.withColumns(columns)


def demand_features(grid: DataFrame) -> DataFrame:
    """Calendar, lag and rolling features."""
    return with_rolling(with_lags(with_time_features(grid)))


def sliced_demand_features(grid: DataFrame, hours: int = SLICE_HOURS) -> DataFrame:
    """``demand_features`` of a complete grid, with a partition per zone and slice instead of one per zone."""
    rows = in_slices(with_time_features(grid), hours)
    return without_halo(with_rolling(with_lags(rows, by_slice()), by_slice()))


def month_grid_with_history(demand: DataFrame, zones: DataFrame, year: int, month: int) -> DataFrame:
    """The month's grid preceded by the previous month's last 168 hours.

    ``demand`` may hold any period; only the two intervals are read. The history part is left
    out when the previous month has no demand at all, so that lags are then empty, not zero.
    """
    start, end = month_span(year, month)
    history_start = start - timedelta(hours=HISTORY_HOURS)
    hour = timedelta(hours=1)
    current = complete_grid(
        between_moments(demand, "pickup_hour", start, end), zones, str(start), str(end - hour)
    )
    month_before = month_span(*shift_month(year, month, -1))
    if between_moments(demand, "pickup_hour", *month_before).isEmpty():
        return current
    history = complete_grid(
        between_moments(demand, "pickup_hour", history_start, start),
        zones,
        str(history_start),
        str(start - hour),
    )
    return history.unionByName(current)


def trim_to_month(features: DataFrame, year: int, month: int) -> DataFrame:
    """Keep the month itself once the windows have used the hours before it."""
    return between_moments(features, "pickup_hour", *month_span(year, month))


def month_features(demand: DataFrame, zones: DataFrame, year: int, month: int) -> DataFrame:
    """Features of one month whose first hours look back into the month before."""
    grid = month_grid_with_history(demand, zones, year, month)
    return trim_to_month(demand_features(grid), year, month)
