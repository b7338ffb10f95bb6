"""Choosing and publishing the model that forecasts arbitrary future hours.

The models see zone-hour demand, not trips: 8,760 rows per zone and year. The profile is measured, and
the linear candidate fitted and measured from sums, for all months in one pass each; the others are
fitted for each of at most four months, some fits at once. Every fit and every prediction is a Spark
job, and one aggregate per fit measures it.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from hailgrid.fixed import (
    BACKTEST_MONTHS,
    BOOSTED_SETTINGS,
    FOREST_SETTINGS,
    FUTURE_FEATURES,
    LINEAR_SETTINGS,
    PROFILE_MODEL,
)
from hailgrid.functions.storage import new_folder
from hailgrid.models.evaluation import (
    clipped,
    error_measures,
    fold_sizes,
    latest_k_months,
    profile_baseline,
)
from hailgrid.models.linear_sums import linear_backtest
from hailgrid.operators.profiles import (
    dropna_features,
    future_scoring_grid,
    historical_profile_features,
)

LINEAR_MODEL = "linear_regression"
#: Fits that run at the same time; each holds its own training rows in memory or on disk, and trees in the driver.
FITS_AT_ONCE = 2
DETAIL_DDL = (
    "model STRING, test_month DATE, train_rows BIGINT, test_rows BIGINT, mae DOUBLE, rmse DOUBLE"
)


def zone_encoding() -> list:
    """Stages that index and one-hot encode the zone and assemble the feature vector."""
    return [
        StringIndexer(inputCol="LocationID", outputCol="zone_index", handleInvalid="keep"),
        OneHotEncoder(inputCol="zone_index", outputCol="zone_onehot", handleInvalid="keep"),
        VectorAssembler(inputCols=[*FUTURE_FEATURES, "zone_onehot"], outputCol="features"),
    ]


def regressors(overrides: dict[str, dict] | None = None) -> dict[str, Estimator]:
    """The trainable candidates. ``overrides`` maps a model name to changed settings."""
    changed = overrides or {}
    roles = {"featuresCol": "features", "labelCol": "demand", "predictionCol": "prediction"}
    kinds = {
        LINEAR_MODEL: (LinearRegression, LINEAR_SETTINGS),
        # Trees remember which node each row has reached; without it rows descend anew from all roots at each level.
        "random_forest": (RandomForestRegressor, {**FOREST_SETTINGS, "cacheNodeIds": True}),
        "gradient_boosted_trees": (GBTRegressor, BOOSTED_SETTINGS),
    }
    return {
        name: kind(**roles, **{**settings, **changed.get(name, {})})
        for name, (kind, settings) in kinds.items()
    }


def candidate_models(overrides: dict[str, dict] | None = None) -> dict[str, Pipeline]:
    """Each candidate with the encoding stages in front of it."""
    return {
        name: Pipeline(stages=[*zone_encoding(), regressor])
        for name, regressor in regressors(overrides).items()
    }


@dataclass
class Backtest:
    """Errors per model and month, and their means per model."""

    detail: DataFrame
    summary: DataFrame


def backtest_months(rows: DataFrame, k: int = BACKTEST_MONTHS) -> list[date]:
    """The holdout months; each must have earlier rows to train on."""
    months = [row["calendar_month"] for row in latest_k_months(rows, k).collect()]
    if not months:
        raise RuntimeError("no month has profiles from earlier months")
    first = rows.agg(F.min("calendar_month")).first()[0]
    if months[0] <= first:
        raise RuntimeError(f"holdout {months[0]} has no earlier month to train on")
    return months


def backtest_rows(demand: DataFrame) -> DataFrame:
    """Demand with every future-safe feature known before its month, as a double label."""
    rows = dropna_features(historical_profile_features(demand))
    return rows.withColumn("demand", F.col("demand").cast("double"))


def stored_rows(rows: DataFrame) -> DataFrame:
    """``rows`` written once and read back in the same parts and order, on which the draws of the trees depend.

    What has been read from files carries no plan before it, which otherwise goes out with every task of every fit.
    """
    folder = new_folder(rows.sparkSession, "backtest")
    placed = rows.withColumns({"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id()})
    rows.persist(StorageLevel.MEMORY_AND_DISK)  # writing rows that aren't kept would put small parts together
    try:
        placed.write.parquet(folder)
    finally:
        rows.unpersist()
    stored = rows.sparkSession.read.schema(placed.schema).parquet(folder)
    parts = (stored.agg(F.max("__part")).first()[0] or 0) + 1
    return stored.repartitionById(parts, "__part").sortWithinPartitions("__place").drop("__part", "__place")


def backtest_folds(rows: DataFrame, months: list[date]) -> DataFrame:
    """Every model and holdout month with the numbers of rows trained on and tested; nothing is fitted."""
    models = F.array(*[F.lit(name) for name in (PROFILE_MODEL, *regressors())])
    return fold_sizes(rows, months).select(
        F.explode(models).alias("model"), "test_month", "train_rows", "test_rows"
    )


def baseline_backtest(rows: DataFrame, months: list[date]) -> DataFrame:
    """Errors of the profile, which is never fitted, in all holdout months at once."""
    tested = rows.where(F.col("calendar_month").isin(months)).withColumn("test_month", F.col("calendar_month"))
    return profile_baseline(tested).groupBy("test_month").agg(*error_measures())


def rolling_backtest(
    demand: DataFrame, overrides: dict[str, dict] | None = None, k: int = BACKTEST_MONTHS
) -> Backtest:
    """For each of the last ``k`` months: train on strictly earlier months, test on that month."""
    spark = demand.sparkSession
    rows = stored_rows(backtest_rows(demand)).persist(StorageLevel.MEMORY_AND_DISK)
    penalty = _ridge_penalty(overrides)
    errors = {}
    try:
        months = backtest_months(rows, k)
        for row in baseline_backtest(rows, months).collect():
            errors[PROFILE_MODEL, row["test_month"]] = (row["mae"], row["rmse"])
        if penalty is not None:  # all months at once, from sums
            for row in linear_backtest(rows, months, penalty).collect():
                errors[LINEAR_MODEL, row["test_month"]] = (row["mae"], row["rmse"])
        errors |= _fitted_errors(rows, months, overrides, penalty is None)
        results = [(*fold, *errors[fold["model"], fold["test_month"]]) for fold in backtest_folds(rows, months).collect()]
    finally:
        rows.unpersist()
    detail = spark.createDataFrame(results, DETAIL_DDL)
    return Backtest(detail, backtest_summary(detail))


def _ridge_penalty(overrides: dict[str, dict] | None) -> float | None:
    """The penalty of the linear candidate if sums can fit it: a ridge regression with Spark's other defaults."""
    changed = (overrides or {}).get(LINEAR_MODEL, {})
    settings = {**LINEAR_SETTINGS, **changed}
    plain = settings["elasticNetParam"] == 0.0 < settings["regParam"] and set(changed) <= set(LINEAR_SETTINGS)
    return settings["regParam"] if plain else None


def _fitted_errors(
    rows: DataFrame, months: list[date], overrides: dict[str, dict] | None, linear: bool
) -> dict[tuple[str, date], tuple[float, float]]:
    """Errors of the models that are fitted per month. The zones of a month are encoded once for all of them.

    A fit is a chain of short jobs that leave cores idle, so several fits run at once.
    """
    work, kept = [], []
    try:
        for month in reversed(months):  # the longest history first
            train = rows.where(F.col("calendar_month") < F.lit(month))
            encoder = Pipeline(stages=zone_encoding()).fit(train)
            fit_rows = encoder.transform(train).select("features", "demand").persist(StorageLevel.MEMORY_AND_DISK)
            kept.append(fit_rows)
            tested = encoder.transform(rows.where(F.col("calendar_month") == F.lit(month)))
            for name, regressor in regressors(overrides).items():
                if name != LINEAR_MODEL or linear:
                    work.append(partial(_fit_and_measure, name, month, regressor, fit_rows, tested))
        bound = map(inheritable_thread_target(rows.sparkSession), work)
        with ThreadPool(FITS_AT_ONCE) as pool:
            return dict(pool.imap_unordered(lambda fit: fit(), bound))
    finally:
        for fit_rows in kept:
            fit_rows.unpersist()


def _fit_and_measure(name: str, month: date, regressor: Estimator, fit_rows: DataFrame, tested: DataFrame):
    found = clipped(regressor.fit(fit_rows).transform(tested)).agg(*error_measures()).first()
    # The driver lets go of the broadcasts and shuffle files of a fit's jobs when its garbage is collected, not before.
    fit_rows.sparkSession.sparkContext._jvm.System.gc()
    return (name, month), (found["mae"], found["rmse"])


def backtest_summary(detail: DataFrame) -> DataFrame:
    """Mean errors per model over its holdout months."""
    return detail.groupBy("model").agg(
        F.avg("mae").alias("mae"),
        F.avg("rmse").alias("rmse"),
        F.count(F.lit(1)).cast("int").alias("backtest_months"),
    )


def future_profiles(
    demand: DataFrame, winner: str = PROFILE_MODEL, overrides: dict[str, dict] | None = None
) -> DataFrame:
    """Predicted demand per zone, month, weekday and hour, never negative.

    The profile baseline is read off the scoring grid; any other winner is first fitted to all
    history.
    """
    grid = dropna_features(future_scoring_grid(demand))
    if winner == PROFILE_MODEL:
        scored = profile_baseline(grid)
    else:
        candidates = candidate_models(overrides)
        if winner not in candidates:
            raise ValueError(f"unknown model: {winner}")
        history = dropna_features(historical_profile_features(demand))
        fitted = candidates[winner].fit(history.withColumn("demand", F.col("demand").cast("double")))
        scored = clipped(fitted.transform(grid))
    return scored.select(
        F.col("LocationID").alias("location_id"),
        "month",
        "day_of_week",
        "hour",
        F.col("prediction").alias("predicted_demand"),
    )


def forecast_metadata(demand: DataFrame, profile: DataFrame, winner: str) -> DataFrame:
    """The one-row description of a published forecast."""
    latest = demand.agg(F.max("pickup_hour")).scalar()
    return profile.agg(F.count(F.lit(1)).alias("profile_rows")).select(
        F.lit(winner).alias("production_model"),
        latest.alias("trained_through"),
        F.current_timestamp().alias("generated_at"),
        F.array(*[F.lit(c) for c in ("LocationID", "month", "day_of_week", "hour")]).alias(
            "profile_dimensions"
        ),
        "profile_rows",
    )
