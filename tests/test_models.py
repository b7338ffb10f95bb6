from datetime import date, datetime, timedelta
from threading import Barrier

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from hailgrid.fixed import HISTORICAL_MODEL, PERSISTENCE_MODEL, PROFILE_MODEL
from hailgrid.functions.storage import new_folder
from hailgrid.models import future as fut
from hailgrid.models import historical as hist
from hailgrid.models.evaluation import error_measures, winner_name
from hailgrid.models.linear_sums import linear_backtest, linear_predictions, month_sums, sums_before
from hailgrid.operators.demand import complete_grid
from hailgrid.operators.history import demand_features
from hailgrid.operators.profiles import dropna_features, historical_profile_features
from hailgrid.plans import forecast_queries as questions
from hailgrid.plans import publish
from hailgrid.sinks.snapshots import read_snapshot
from oracle.cases_models import demand_grid_features
from tests.rows import demand_frame, zones_frame

TINY = {
    "random_forest": {"numTrees": 2, "maxDepth": 2},
    "gradient_boosted_trees": {"maxIter": 1, "maxDepth": 2},
    "linear_regression": {"maxIter": 2},
}


def hours(first, count, zone):
    start = datetime.fromisoformat(first)
    return [(zone, str(start + timedelta(hours=h)), (h % 24) + zone) for h in range(0, count, 3)]


@pytest.fixture(scope="module")
def demand(spark):
    rows = [row for zone in (1, 2) for row in hours("2024-01-01 00:00:00", 24 * 181, zone)]
    return demand_frame(spark, rows).cache()


def test_backtest_uses_the_last_four_months(spark, demand):
    result = fut.rolling_backtest(demand, TINY)
    months = sorted({r["test_month"] for r in result.detail.collect()})
    assert months == [date(2024, m, 1) for m in (3, 4, 5, 6)]
    first = result.detail.where("test_month = DATE '2024-03-01'").first()
    assert first["train_rows"] > 0 and first["test_rows"] == 2 * 31 * 8
    assert result.summary.count() == 4
    # The demand repeats daily, so the profile is perfect and must win.
    assert winner_name(result.summary) == PROFILE_MODEL
    assert result.detail.where(f"model = '{PROFILE_MODEL}'").agg(F.max("mae")).first()[0] == pytest.approx(0)


@pytest.mark.parametrize("penalty", [0.1, 5.0])  # without a penalty one-hot zones have no unique solution
def test_linear_model_from_sums_equals_fits(spark, demand, penalty):
    """Errors and every prediction, against Spark's normal solver for each month; a zone appears late."""
    late = demand_frame(spark, [(7, f"2024-04-{d:02d} {h:02d}:00:00", 3 * h + d % 5) for d in range(1, 29) for h in range(0, 24, 5)])
    noisy = demand.unionByName(late).withColumn("demand", F.col("demand") + F.pmod(F.hash("LocationID", "pickup_hour"), F.lit(9)))
    rows = dropna_features(historical_profile_features(noisy)).withColumn("demand", F.col("demand").cast("double")).cache()
    months = fut.backtest_months(rows)
    found = linear_predictions(rows, months, penalty).select("test_month", "LocationID", "pickup_hour", "prediction")
    got = {tuple(r)[:3]: r.prediction for r in found.collect()}
    # The first model sees one month only. Its month is constant, and Spark's solver gives a constant feature a
    # coefficient out of rounding errors, which depends on the partitions.
    for key in [key for key in got if key[0] == months[0]]:
        del got[key]
    for row in linear_backtest(rows, months, penalty).where(F.col("test_month") > F.lit(months[0])).collect():
        train, test = rows.where(F.col("calendar_month") < F.lit(row.test_month)), rows.where(F.col("calendar_month") == F.lit(row.test_month))
        model = fut.candidate_models({"linear_regression": {"regParam": penalty, "solver": "normal"}})["linear_regression"].fit(train)
        scored = fut.clipped(model.transform(test)).cache()
        errors = scored.agg(*error_measures()).first()
        assert (row.mae, row.rmse) == (pytest.approx(errors.mae, abs=1e-6), pytest.approx(errors.rmse, abs=1e-6))
        assert (row.train_rows, row.test_rows) == (train.count(), test.count())
        for r in scored.collect():
            assert got.pop((row.test_month, r.LocationID, r.pickup_hour)) == pytest.approx(r.prediction, abs=1e-6)
    assert not got


def test_sums_of_months_add_up(demand):
    rows = dropna_features(historical_profile_features(demand))
    months = fut.backtest_months(rows)
    before = sums_before(month_sums(rows), months[-1:]).groupBy().agg(F.sum("one__one"), F.sum("one__demand")).first()
    early = rows.where(F.col("calendar_month") < F.lit(months[-1])).agg(F.count("*"), F.sum("demand")).first()
    assert tuple(before) == tuple(early)


def test_backtest_without_a_training_month_fails(demand):
    with pytest.raises(RuntimeError, match="no earlier month"):
        fut.rolling_backtest(demand.where("month(pickup_hour) <= 3"), TINY)
    with pytest.raises(RuntimeError, match="profiles"):
        fut.rolling_backtest(demand.where("month(pickup_hour) = 1"), TINY)


def test_published_profile(demand):
    profile = fut.future_profiles(demand)
    assert profile.count() == 2 * 12 * 7 * 8
    assert profile.where("location_id = 2 AND hour = 3").agg(F.min("predicted_demand")).first()[0] == 5.0
    trained = fut.future_profiles(demand, "linear_regression", TINY)
    assert trained.count() == profile.count()
    assert trained.agg(F.min("predicted_demand")).first()[0] >= 0
    with pytest.raises(ValueError):
        fut.future_profiles(demand, "oracle")
    described = fut.forecast_metadata(demand, profile, PROFILE_MODEL).first()
    assert described["profile_rows"] == 2 * 12 * 7 * 8
    assert described["trained_through"] == datetime(2024, 6, 29, 21)


def test_historical_run(spark, demand, tmp_path):
    grid = complete_grid(demand, zones_frame(spark, 1, 2), "2024-04-01 00:00:00", "2024-06-28 23:00:00")
    run = hist.store_run(hist.train_historical(demand_features(grid), numTrees=2, maxDepth=3), str(tmp_path))
    errors = {r["model"]: r["mae"] for r in run.metrics.collect()}
    assert set(errors) == {HISTORICAL_MODEL, PERSISTENCE_MODEL}
    assert errors[PERSISTENCE_MODEL] == pytest.approx(0)
    assert run.importance.count() == 13
    assert run.importance.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    assert run.predictions.agg(F.min("pickup_hour")).first()[0] == datetime(2024, 6, 1)
    tables = hist.historical_serving_tables(run, zones_frame(spark, 1))
    served = tables["historical_model_prediction"]
    assert {r["location_id"] for r in served.select("location_id").distinct().collect()} == {1}
    assert served.first()["trained_through"] == datetime(2024, 6, 28, 23)


def test_publishing_jobs(spark, demand, tmp_path):
    root = str(tmp_path)
    assert publish.select_future_model(demand, root, TINY) == PROFILE_MODEL
    publish.publish_future_forecast(spark, demand, root, TINY)
    forecast = f"{root}/future_forecast"
    described = questions.forecast_metadata(read_snapshot(spark, forecast, "future_forecast_metadata")).first()
    assert described["production_model"] == PROFILE_MODEL
    assert described["profile_rows"] == read_snapshot(spark, forecast, "future_demand_profile").count()
    metrics = questions.future_model_metrics(read_snapshot(spark, forecast, "future_model_metric")).collect()
    assert metrics[0]["model"] == PROFILE_MODEL and metrics[0]["backtest_months"] == 4

    grid = complete_grid(demand, zones_frame(spark, 1, 2), "2024-05-01 00:00:00", "2024-06-28 23:00:00")
    publish.publish_historical_model(
        spark, demand_features(grid), zones_frame(spark, 1, 2), root, numTrees=2, maxDepth=2
    )
    served = read_snapshot(spark, f"{root}/historical_model", "historical_model_metric")
    assert questions.historical_model_metrics(served).count() == 2
    importance = read_snapshot(spark, f"{root}/historical_model", "historical_feature_importance")
    ranked = [r["importance"] for r in questions.feature_importance_ranked(importance).collect()]
    assert ranked == sorted(ranked, reverse=True)


def test_folds_and_baseline_need_no_fit(spark, demand, monkeypatch):
    """Sizes and the profile's errors are those of the whole backtest, whose fits they do not wait for."""
    detail = fut.rolling_backtest(demand, TINY).detail
    whole = {(r.model, r.test_month): (r.train_rows, r.test_rows) for r in detail.collect()}
    baseline = {r.test_month: (r.mae, r.rmse) for r in detail.where(f"model = '{PROFILE_MODEL}'").collect()}
    for kind in (fut.RandomForestRegressor, fut.GBTRegressor, fut.LinearRegression):
        monkeypatch.setattr(kind, "fit", lambda *_: pytest.fail("a model was fitted"))
    rows = fut.backtest_rows(demand).cache()
    months = fut.backtest_months(rows)
    assert {(r.model, r.test_month): (r.train_rows, r.test_rows) for r in fut.backtest_folds(rows, months).collect()} == whole
    for row in fut.baseline_backtest(rows, months).collect():
        assert (row.mae, row.rmse) == pytest.approx(baseline.pop(row.test_month), abs=1e-9)
    assert not baseline
    for month in months:
        sizes = (rows.where(F.col("calendar_month") < F.lit(month)).count(), rows.where(F.col("calendar_month") == F.lit(month)).count())
        assert sizes == whole[PROFILE_MODEL, month]


def test_several_fits_run_at_once(demand, monkeypatch):
    """Two fits must be under way together, or the barrier breaks."""
    together, fit = Barrier(2, timeout=60), fut.GBTRegressor.fit

    def waiting(*args):
        together.wait()
        return fit(*args)

    monkeypatch.setattr(fut.GBTRegressor, "fit", waiting)
    assert fut.rolling_backtest(demand, TINY, k=2).detail.count() == 8


def test_fits_get_stored_rows_in_the_same_parts(spark, demand, monkeypatch):
    """No plan before the stored rows goes out with the tasks of a fit, and the draws of the trees stay the same."""
    seen, fit = [], fut.GBTRegressor.fit

    def watched(self, rows):
        seen.append("Join" in rows._jdf.queryExecution().executedPlan().toString())
        return fit(self, rows)

    monkeypatch.setattr(fut.GBTRegressor, "fit", watched)
    assert fut.rolling_backtest(demand, TINY, k=2).detail.count() == 8
    assert seen == [False, False]
    rows = fut.backtest_rows(demand).repartition(5, "day_of_week", "hour").cache()
    parts = [list(map(tuple, part)) for part in rows.rdd.glom().collect()]
    assert [list(map(tuple, part)) for part in fut.stored_rows(rows).rdd.glom().collect()] == parts
    assert fut.stored_rows(rows.where("hour > 99")).count() == 0


def test_remembered_nodes_change_no_tree(demand):
    rows = fut.backtest_rows(demand)
    train = Pipeline(stages=fut.zone_encoding()).fit(rows).transform(rows).cache()
    forest = fut.regressors({"random_forest": {"numTrees": 5, "maxDepth": 4}})["random_forest"]
    assert forest.getCacheNodeIds()
    plain = forest.copy().setCacheNodeIds(False)
    assert forest.fit(train).toDebugString.split("\n")[1:] == plain.fit(train).toDebugString.split("\n")[1:]


def test_grid_of_all_months_counts_demand_once(spark, demand, monkeypatch):
    """Trips are counted into demand once; the forest remembers the nodes of rows."""
    uses = []

    class Given:
        folder = staticmethod(lambda label: new_folder(spark, label))
        monthly_demand = property(lambda self: uses.append(1) or demand.where("month(pickup_hour) <= 2"))

    given = Given()
    given.spark = spark
    assert demand_grid_features(given).count() == 2 * (59 * 24 + 22) and len(uses) == 1
    seen = []
    monkeypatch.setattr(hist.RandomForestRegressor, "fit", lambda self, rows: seen.append(self.getCacheNodeIds()) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        hist.train_historical(demand_features(complete_grid(demand, zones_frame(spark, 1, 2), "2024-04-01 00:00:00", "2024-06-28 23:00:00")))
    assert seen == [True]
