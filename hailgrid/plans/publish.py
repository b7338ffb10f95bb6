"""Jobs that train, choose and publish models from stored demand and features.

A winner is chosen from the metrics file that the backtest has written, and serving tables are
built from stored predictions, so no model is fitted or applied twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hailgrid.models.evaluation import ranked_models, winner_name
from hailgrid.models.future import forecast_metadata, future_profiles, rolling_backtest
from hailgrid.models.historical import historical_serving_tables, store_run, train_historical
from hailgrid.sinks.snapshots import snapshot_replace
from hailgrid.sinks.writers import sink_metrics_csv, sink_overwrite
from hailgrid.sources.readers import scan_metrics_csv


def select_future_model(demand: DataFrame, root: str, overrides: dict[str, dict] | None = None) -> str:
    """Backtest all candidates, store detail and summary, and return the winner's name."""
    result = rolling_backtest(demand, overrides)
    sink_metrics_csv(result.detail, f"{root}/future_model_backtest")
    sink_metrics_csv(result.summary, f"{root}/future_model_summary")
    return winner_name(result.summary)


def publish_future_forecast(
    spark: SparkSession, demand: DataFrame, root: str, overrides: dict[str, dict] | None = None
) -> int:
    """Publish profile, metrics and metadata of the stored backtest's winner as one version."""
    summary = scan_metrics_csv(spark, f"{root}/future_model_summary", "future_summary")
    winner = winner_name(summary)
    sink_overwrite(future_profiles(demand, winner, overrides), f"{root}/future_profile")
    profile = spark.read.parquet(f"{root}/future_profile")
    tables = {
        "future_demand_profile": profile,
        "future_model_metric": ranked_models(summary),
        "future_forecast_metadata": forecast_metadata(demand, profile, winner),
    }
    return snapshot_replace(spark, f"{root}/future_forecast", tables)


def publish_historical_model(
    spark: SparkSession, features: DataFrame, zones: DataFrame, root: str, **settings
) -> int:
    """Train the historical forest, store the run and publish its serving tables."""
    run = store_run(train_historical(features, **settings), f"{root}/historical_run")
    if run.predictions.isEmpty():
        raise RuntimeError("there are no historical predictions to publish")
    return snapshot_replace(spark, f"{root}/historical_model", historical_serving_tables(run, zones))
