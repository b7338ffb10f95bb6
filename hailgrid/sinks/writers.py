"""Writing datasets. Everything is written by the tasks that hold it; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sink_overwrite(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def sink_months(rows: DataFrame, root: str, at: str, replace_all: bool = False) -> None:
    """Replace the months that occur in ``rows``; other months stay.

    ``rebalance`` gives each month as many evenly sized files as its data needs, so a month
    that holds most rows is not written by one task. Running a month again changes nothing.
    ``replace_all`` drops every other month as well (full refresh). To replace a month whatever
    its rows, use ``sink_month``.
    """
    _write_months(_by_month(rows, at), root, replace_all)


def sink_month(rows: DataFrame, root: str, at: str, month: tuple[int, int], order: tuple[str, ...] = ()) -> None:
    """Replace one month by its rows; without rows nothing of the month is left."""
    year, number = month
    own = _by_month(rows, at).where((F.col("year") == year) & (F.col("month") == number)).drop("year", "month")
    own = own.hint("rebalance")
    own = own.sortWithinPartitions(*order) if order else own
    own.write.mode("overwrite").parquet(f"{root}/year={year}/month={number}")


ZONE_HOUR_ORDER = ("LocationID", "date", "hour")


def sink_zone_hour_daily(daily: DataFrame, root: str, replace_all: bool = False) -> None:
    """The zone-hour-day table by month, rows of a file ordered by zone, date and hour."""
    ordered = _by_month(daily, "date").sortWithinPartitions("year", "month", *ZONE_HOUR_ORDER)
    _write_months(ordered, root, replace_all)


def _by_month(rows: DataFrame, at: str) -> DataFrame:
    dated = rows.withColumns({"year": F.year(at), "month": F.month(at)})
    return dated.hint("rebalance", "year", "month")


def _write_months(rows: DataFrame, root: str, replace_all: bool) -> None:
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy("year", "month")
        .parquet(root)
    )


def sink_metrics_csv(metrics: DataFrame, path: str) -> None:
    """A metrics table (a row per model, feature or holdout month) as one CSV file."""
    metrics.coalesce(1).write.mode("overwrite").csv(path, header=True)


def sink_model(model, path: str) -> None:
    model.write().overwrite().save(path)
