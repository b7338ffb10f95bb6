"""The historical demand model: a random forest on lag and rolling features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from hailgrid.fixed import (
    FOREST_SETTINGS,
    HISTORICAL_FEATURES,
    HISTORICAL_MODEL,
    PERSISTENCE_MODEL,
)
from hailgrid.models.evaluation import (
    filter_full_history,
    regression_metrics,
    time_split_last_month,
)
from hailgrid.sinks.writers import sink_metrics_csv, sink_model, sink_overwrite
from hailgrid.sources.readers import scan_metrics_csv


@dataclass
class HistoricalRun:
    """What one training run leaves behind."""

    model: RandomForestRegressionModel
    predictions: DataFrame
    metrics: DataFrame
    importance: DataFrame


def assemble_features(rows: DataFrame) -> DataFrame:
    """The thirteen historical features as one vector column."""
    return VectorAssembler(inputCols=HISTORICAL_FEATURES, outputCol="features_vector").transform(rows)


def feature_importance(model: RandomForestRegressionModel, spark) -> DataFrame:
    """Importance per feature, highest first."""
    pairs = [(name, float(v)) for name, v in zip(HISTORICAL_FEATURES, model.featureImportances.toArray())]
    ranked = spark.createDataFrame(pairs, "feature STRING, importance DOUBLE")
    return ranked.orderBy(F.desc("importance"), "feature")


def train_historical(features: DataFrame, **settings) -> HistoricalRun:
    """Hold out the latest month, fit the forest, and compare it with 24-hour persistence.

    Keyword arguments override forest settings (fewer trees for a quick run, say). The
    training rows are cached for the many passes of the fit and released afterwards.
    """
    train, test = time_split_last_month(filter_full_history(features))
    forest = RandomForestRegressor(
        featuresCol="features_vector",
        labelCol="demand",
        predictionCol="prediction",
        # Trees remember which node each row has reached; without it rows descend anew from all roots at each level.
        **{**FOREST_SETTINGS, "cacheNodeIds": True, **settings},
    )
    fit_rows = assemble_features(train).select("features_vector", "demand")
    fit_rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if fit_rows.isEmpty():
            raise RuntimeError("no feature rows lie before the latest month")
        model = forest.fit(fit_rows)
    finally:
        fit_rows.unpersist()
    predicted = model.transform(assemble_features(test))
    # Both models are measured on the same rows in one pass.
    answers = F.array(
        F.struct(F.lit(HISTORICAL_MODEL).alias("model"), F.col("prediction")),
        F.struct(F.lit(PERSISTENCE_MODEL).alias("model"), F.col("lag_24h").cast("double").alias("prediction")),
    )
    both = predicted.select("demand", F.explode(answers).alias("answer")).select("demand", "answer.*")
    return HistoricalRun(
        model=model,
        predictions=predicted.select("LocationID", "pickup_hour", "demand", "prediction"),
        metrics=regression_metrics(both, "model").orderBy("model"),
        importance=feature_importance(model, features.sparkSession),
    )


def store_run(run: HistoricalRun, root: str) -> HistoricalRun:
    """Write the results of a run and return it reading from what was written."""
    spark = run.importance.sparkSession
    sink_overwrite(run.predictions, f"{root}/predictions")
    sink_metrics_csv(run.metrics, f"{root}/model_metrics")
    sink_metrics_csv(run.importance, f"{root}/feature_importance")
    sink_model(run.model, f"{root}/models/random_forest")
    return HistoricalRun(
        model=run.model,
        predictions=spark.read.parquet(f"{root}/predictions"),
        metrics=scan_metrics_csv(spark, f"{root}/model_metrics", "historical_metrics"),
        importance=scan_metrics_csv(spark, f"{root}/feature_importance", "feature_importance"),
    )


def join_predictions_zones(predictions: DataFrame, zones: DataFrame) -> DataFrame:
    """Predictions of existing zones in serving form."""
    known = predictions.join(zones.select("LocationID").distinct(), "LocationID")
    return known.select(
        "LocationID",
        "pickup_hour",
        F.col("demand").cast("double").alias("actual_demand"),
        F.col("prediction").cast("double").alias("predicted_demand"),
    ).orderBy("LocationID", "pickup_hour")


def historical_serving_tables(run: HistoricalRun, zones: DataFrame) -> dict[str, DataFrame]:
    """Predictions, metrics and importances, each stamped with data and creation time.

    Meant for a stored run; an unstored one would predict again for every table.
    """
    predictions = join_predictions_zones(run.predictions, zones)
    latest = predictions.agg(F.max("pickup_hour")).scalar()
    tables = {
        "historical_model_prediction": predictions.withColumnRenamed("LocationID", "location_id"),
        "historical_model_metric": run.metrics,
        "historical_feature_importance": run.importance,
    }
    return {
        name: table.withColumns({"trained_through": latest, "generated_at": F.current_timestamp()})
        for name, table in tables.items()
    }
