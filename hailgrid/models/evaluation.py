"""Baselines, time splits and error measures, all as DataFrame expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailgrid.fixed import BACKTEST_MONTHS, HISTORY_HOURS, PROFILE_MODEL
from hailgrid.functions.calendar import between_moments


def filter_full_history(features: DataFrame) -> DataFrame:
    """Rows with 168 hours of history, demand as a double label."""
    known = features.where(F.col(f"history_count_{HISTORY_HOURS}h") == HISTORY_HOURS)
    return known.withColumn("demand", F.col("demand").cast("double"))


def latest_timestamp(rows: DataFrame, column: str = "pickup_hour") -> DataFrame:
    """The last observed hour, as a one-row frame."""
    return rows.agg(F.max(column).alias("trained_through"))


def time_split_last_month(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train on everything before the latest calendar month, test on that month.

    The month start is a scalar subquery, so nothing is collected to the driver.
    """
    at = F.col("pickup_hour")
    start = rows.agg(F.trunc(F.max(at), "month").cast("timestamp_ntz").alias("start")).scalar()
    return rows.where(at < start), rows.where(at >= start)


def time_split_fixed(rows: DataFrame, train: tuple, test: tuple) -> tuple[DataFrame, DataFrame]:
    """Explicit half-open train and test periods."""
    return between_moments(rows, "pickup_hour", *train), between_moments(rows, "pickup_hour", *test)


def split_ranges(train: DataFrame, test: DataFrame) -> DataFrame:
    """Row count and first and last hour of both parts."""
    part = train.select(F.lit("train").alias("part"), "pickup_hour").unionAll(
        test.select(F.lit("test"), "pickup_hour")
    )
    return part.groupBy("part").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("pickup_hour").alias("first_hour"),
        F.max("pickup_hour").alias("last_hour"),
    )


def latest_k_months(rows: DataFrame, k: int = BACKTEST_MONTHS) -> DataFrame:
    """The last ``k`` distinct months, in calendar order."""
    months = rows.select("calendar_month").distinct()
    return months.orderBy(F.desc("calendar_month")).limit(k).orderBy("calendar_month")


def fold_sizes(rows: DataFrame, months: list[date]) -> DataFrame:
    """How many rows lie before and in each holdout month, from one count per month."""
    held = F.array(*[F.lit(m) for m in months])
    n = rows.groupBy("calendar_month").agg(F.count(F.lit(1)).alias("n"))
    each = n.withColumn("test_month", F.explode(F.filter(held, lambda m: m >= F.col("calendar_month"))))
    own = F.col("test_month") == F.col("calendar_month")
    return each.groupBy("test_month").agg(
        F.sum(F.when(~own, F.col("n")).otherwise(0)).alias("train_rows"),
        F.sum(F.when(own, F.col("n")).otherwise(0)).alias("test_rows"),
    )


def persistence_baseline(rows: DataFrame) -> DataFrame:
    """Predict the demand of 24 hours ago."""
    return rows.withColumn("prediction", F.col("lag_24h").cast("double"))


def profile_baseline(rows: DataFrame) -> DataFrame:
    """Predict the zone's historical mean of that weekday and hour."""
    return rows.withColumn("prediction", F.greatest(PROFILE_MODEL, F.lit(0.0)))


def clipped(predictions: DataFrame) -> DataFrame:
    """Demand cannot be negative."""
    return predictions.withColumn("prediction", F.greatest("prediction", F.lit(0.0)))


def error_measures() -> list[Column]:
    error = F.col("demand") - F.col("prediction")
    return [F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse")]


def regression_metrics(predictions: DataFrame, *by: str) -> DataFrame:
    """Mean absolute and root mean squared error per group, in one aggregate."""
    return predictions.groupBy(*by).agg(*error_measures())


def ranked_models(summary: DataFrame) -> DataFrame:
    """Models from best to worst: lowest MAE, then RMSE, then name."""
    return summary.orderBy("mae", "rmse", "model")


def select_production_model(summary: DataFrame) -> DataFrame:
    """The winning model, as a one-row frame."""
    return ranked_models(summary).limit(1)


def model_leaderboard(summary: DataFrame) -> DataFrame:
    """Models from best to worst with rounded errors and their status."""
    winner = select_production_model(summary).select("model").scalar()
    status = F.when(F.col("model") == winner, "Production").otherwise("Candidate")
    return ranked_models(summary).select(
        "model",
        F.round("mae", 2).alias("mae"),
        F.round("rmse", 2).alias("rmse"),
        status.alias("status"),
    )


def winner_name(summary: DataFrame) -> str:
    """Name of the winning model; an empty summary is an error."""
    best = select_production_model(summary).first()
    if best is None:
        raise ValueError("there is no model to choose from")
    return best["model"]
