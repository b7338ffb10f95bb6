"""Quantiles of any span of time from small stored summaries, with a bound on the error of ranks.

A summary of a period keeps, of all known values of a column in order, those at which the count passes a multiple
of ``step = known // parts`` rows, and the largest, each with the number of rows since the value kept before. It has
at most ``2 * parts + 1`` rows, however many rows the period has; a period of fewer than ``2 * parts`` rows is kept
whole. Fewer than ``step`` rows lie between a value and the weights kept up to it.

Summaries are merged by putting their rows together: nothing is compressed again, so periods may come in any order,
and a rebuilt period replaces its own summary. The errors of the periods add up to at most the sum of ``step - 1``,
which is less than a share of ``1 / parts`` of all rows.

Rows are counted in narrow buckets of the value first; only of buckets in which the count passes a multiple of
``step``, or that hold the largest value, are values counted and ordered. These are at most ``parts + 1`` for a period
and column. Neither a frequent value nor a long period gathers in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hailgrid.operators.profiling import value_bucket
from hailgrid.sinks.writers import sink_month, sink_months

PARTS = 1000
UNITS_OF_TIME = ("month", "day")
#: Periods in twenty years. If the buckets that hold kept values of so many are few, they are broadcast.
LONG_SPAN = {"month": 240, "day": 7305}
BROADCAST_BUCKETS = 1_000_000
_SERIES = ["period", "column_name"]


def _before(*order: str, of: list[str], what: str) -> Column:
    window = Window.partitionBy(*of).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(what).over(window), F.lit(0))


def period_summaries(
    rows: DataFrame, at: str, columns: dict[str, Column], unit: str = "month", parts: int = PARTS
) -> DataFrame:
    """``period, column_name, value, weight, step`` of each period, a month or a day, in which a column has values.

    Rows without a time, and empty values or those that are not a number, take no part.
    """
    if unit not in UNITS_OF_TIME or parts < 1:
        raise ValueError(f"unit must be one of {UNITS_OF_TIME} and parts at least 1")
    values = rows.where(F.col(at).isNotNull()).select(
        F.date_trunc(unit, at).cast("date").alias("period"),
        *[value.cast("double").alias(name) for name, value in columns.items()],
    )
    values = values.unpivot(["period"], list(columns), "column_name", "value")
    values = values.where(F.col("value").isNotNull() & ~F.isnan("value"))
    series = Window.partitionBy(*_SERIES)
    buckets = values.groupBy(*_SERIES, value_bucket(F.col("value")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    buckets = buckets.select(
        *_SERIES, "bucket", "n", F.sum("n").over(series).alias("known"), _before("bucket", of=_SERIES, what="n").alias("below")
    ).withColumn("step", F.greatest(F.lit(1).cast("bigint"), F.expr(f"known div {parts}")))
    held = buckets.where("(below + n) div step > below div step OR below + n = known").drop("n")

    # Values of other buckets are not kept, so they need not be counted.
    keys = [*_SERIES, "bucket"]
    if LONG_SPAN[unit] * len(columns) * (parts + 1) <= BROADCAST_BUCKETS:
        some = values.withColumn("bucket", value_bucket(F.col("value")))
        values = some.join(F.broadcast(held.select(*keys)), keys, "left_semi").drop("bucket")
    counts = values.groupBy(*_SERIES, "value").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("bucket", value_bucket(F.col("value")))
    placed = counts.join(held, keys).withColumn("before", F.col("below") + _before("value", of=keys, what="n"))
    placed = placed.withColumn("through", F.col("before") + F.col("n"))
    kept = placed.where("through div step > before div step OR through = known")
    previous = F.lag("through", 1, 0).over(Window.partitionBy(*_SERIES).orderBy("value"))
    return kept.select(*_SERIES, "value", (F.col("through") - previous).alias("weight"), "step")


def store_summaries(summaries: DataFrame, root: str, month: tuple[int, int] | None = None) -> None:
    """Replace the months that occur in ``summaries``, or one month, which may have none left.

    A month's days are written together, from all trips of the month.
    """
    if month is None:
        sink_months(summaries, root, "period")
    else:
        sink_month(summaries, root, "period", month)


def _merged(summaries: DataFrame) -> DataFrame:
    """Values of all periods with their weights added up, and how many rows these count up to each."""
    whole = summaries.groupBy("column_name", "value").agg(F.sum("weight").alias("weight"))
    upto = F.sum("weight").over(Window.partitionBy("column_name").orderBy("value"))
    return whole.withColumn("through", upto)


def _bounds(summaries: DataFrame) -> DataFrame:
    """Known rows of each column, and by how many rows a rank may be wrong."""
    periods = summaries.groupBy(*_SERIES).agg(F.sum("weight").alias("rows"), F.max("step").alias("step"))
    return periods.groupBy("column_name").agg(
        F.sum("rows").alias("known_rows"), F.sum(F.col("step") - 1).alias("rank_error")
    )


def span_quantiles(summaries: DataFrame, probabilities: list[float]) -> DataFrame:
    """Quantiles over all periods of ``summaries``, one row per column and probability.

    The wanted rank ``ceil(p * known_rows)``, at least 1, or one that is at most ``rank_error`` rows after it,
    is a rank of ``quantile_value`` in the rows behind the summaries. Without an error the quantile is exact.
    """
    levels = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    wanted = _bounds(summaries).select("*", levels)
    rank = F.greatest(F.ceil(F.col("probability") * F.col("known_rows")), F.lit(1))
    reached = _merged(summaries).join(F.broadcast(wanted), "column_name").where(F.col("through") >= rank)
    return reached.groupBy("column_name", "probability", "known_rows", "rank_error").agg(
        F.min("value").alias("quantile_value")
    )


def span_rows_upto(summaries: DataFrame, limits: list[float]) -> DataFrame:
    """How many rows have at most a value: a least and a greatest number per column and limit."""
    levels = F.explode(F.array(*[F.lit(float(x)) for x in limits])).alias("upto")
    wanted = _bounds(summaries).select("*", levels)
    below = F.col("value") <= F.col("upto")
    counted = summaries.join(F.broadcast(wanted), "column_name").groupBy(
        "column_name", "upto", "known_rows", "rank_error"
    ).agg(F.coalesce(F.sum(F.when(below, F.col("weight"))), F.lit(0)).alias("least_rows"))
    most = F.least("known_rows", F.col("least_rows") + F.col("rank_error"))
    return counted.select("column_name", "upto", "known_rows", "least_rows", most.alias("most_rows"))
