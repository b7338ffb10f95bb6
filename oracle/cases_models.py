"""Profiles, splits, baselines, models and forecasts."""

from __future__ import annotations

from datetime import date, datetime
from functools import lru_cache

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hailgrid.fixed import (
    BACKTEST_MONTHS,
    FUTURE_FEATURES,
    HISTORICAL_FEATURES,
    LINEAR_SETTINGS,
    PROFILE_MODEL,
)
from hailgrid.models import evaluation as e
from hailgrid.models import future as fut
from hailgrid.models import historical as hist
from hailgrid.models import linear_sums as sums
from hailgrid.operators import profile_store as store
from hailgrid.operators import profiles as p
from hailgrid.operators.demand import complete_grid
from hailgrid.operators.history import demand_features
from hailgrid.plans import forecast_queries as f
from hailgrid.sinks.writers import sink_months, sink_overwrite
from oracle.cases_demand import rounded
from oracle.registry import check

# --- Profiles ---------------------------------------------------------------------------


@check("profile_means_full", """SELECT "LocationID", day_of_week, hour,
    ROUND(zone_mean_demand, 6) AS zone_mean_demand, ROUND(zone_hour_mean, 6) AS zone_hour_mean,
    ROUND(zone_dow_hour_mean, 6) AS zone_dow_hour_mean FROM scoring WHERE month = 1""")
def _(t):
    return rounded(p.full_profiles(t.monthly_demand))


@check("month_partials", "SELECT * FROM partials")
def _(t):
    return p.month_partials(t.monthly_demand)


for _keys in (["LocationID"], ["LocationID", "hour"]):
    _names = ", ".join(f'"{k}"' for k in _keys)

    @check(
        "month_partials_zone" + ("_hour" if "hour" in _keys else ""),
        f"""SELECT calendar_month, {_names}, CAST(SUM(demand) AS BIGINT) AS demand_sum,
        COUNT(demand) AS demand_count FROM profiled GROUP BY ALL""",
    )
    def _(t, keys=tuple(_keys)):
        return p.coarser_partials(p.month_partials(t.monthly_demand), "calendar_month", *keys)


@check("expanding_profiles", "SELECT * FROM expanding")
def _(t):
    return rounded(p.expanding_profiles(t.monthly_demand))


def profile_store(t) -> str:
    """A store built without some months, which then come in an order of their own, one of them twice."""
    root, at = t.folder("profiles"), F.date_trunc("month", "pickup_hour")
    months = [(r["y"], r["m"]) for r in t.monthly_demand.select(F.year("pickup_hour").alias("y"), F.month("pickup_hour").alias("m")).distinct().orderBy("y", "m").collect()]
    late = [months[len(months) // 2], months[-1], months[0]]
    is_late = F.lit(False)
    for y, m in late:
        is_late |= at == F.lit(datetime(y, m, 1))
    store.build_profiles(t.monthly_demand.where(~is_late), root)
    # At first one month comes with half of its demand.
    store.update_profiles(t.monthly_demand.where("LocationID < 3"), root, *late[0])
    for month in late:
        store.update_profiles(t.monthly_demand, root, *month)
    return root


@check("profile_store_partials", "SELECT * FROM partials")
def _(t):
    return store.stored_partials(t.spark, profile_store(t))


@check("profile_store_expanding", "SELECT * FROM expanding")
def _(t):
    return rounded(store.stored_expanding_profiles(t.spark, profile_store(t)))


@check("profile_store_full", """SELECT "LocationID", day_of_week, hour,
    ROUND(zone_mean_demand, 6) AS zone_mean_demand, ROUND(zone_hour_mean, 6) AS zone_hour_mean,
    ROUND(zone_dow_hour_mean, 6) AS zone_dow_hour_mean FROM scoring WHERE month = 1""")
def _(t):
    return rounded(store.stored_full_profiles(t.spark, profile_store(t)))


@check("join_profiles", """SELECT "LocationID", pickup_hour, demand, calendar_month, day_of_week, hour,
    zone_mean_demand, zone_hour_mean, zone_dow_hour_mean FROM history""")
def _(t):
    return rounded(p.historical_profile_features(t.monthly_demand)).select(
        "LocationID",
        "pickup_hour",
        "demand",
        "calendar_month",
        "day_of_week",
        "hour",
        "zone_mean_demand",
        "zone_hour_mean",
        "zone_dow_hour_mean",
    )


@check("historical_profile_features", "SELECT * FROM history")
def _(t):
    return rounded(p.historical_profile_features(t.monthly_demand))


@check("dropna_subset", "SELECT * FROM known_history")
def _(t):
    return rounded(p.dropna_features(p.historical_profile_features(t.monthly_demand)))


@check("cross_scoring_grid", "SELECT * FROM slots")
def _(t):
    return p.scoring_slots(t.monthly_demand)


SCORING = """SELECT * REPLACE (ROUND(zone_mean_demand, 6) AS zone_mean_demand,
    ROUND(zone_hour_mean, 6) AS zone_hour_mean, ROUND(zone_dow_hour_mean, 6) AS zone_dow_hour_mean)
    FROM scoring"""


@check("future_scoring_grid", SCORING)
def _(t):
    return rounded(p.future_scoring_grid(t.monthly_demand))


# --- Splits and baselines ---------------------------------------------------------------


@check("filter_full_history", "SELECT * FROM model_rows")
def _(t):
    return rounded(e.filter_full_history(t.features))


@check("latest_timestamp", "SELECT MAX(pickup_hour) AS trained_through FROM monthly_demand")
def _(t):
    return e.latest_timestamp(t.monthly_demand)


RANGES = """SELECT part, COUNT(*) AS row_count, MIN(pickup_hour) AS first_hour,
    MAX(pickup_hour) AS last_hour FROM ({0}) GROUP BY 1"""


@check(
    "time_split_last_month",
    RANGES.format(
        """SELECT pickup_hour, CASE WHEN pickup_hour < (SELECT date_trunc('month', MAX(pickup_hour))
        FROM monthly_demand) THEN 'train' ELSE 'test' END AS part FROM monthly_demand"""
    ),
)
def _(t):
    return e.split_ranges(*e.time_split_last_month(t.monthly_demand))


TRAIN = ("2024-01-08 00:00:00", "2024-01-25 00:00:00")
TEST = ("2024-01-25 00:00:00", "2024-02-01 00:00:00")


@check(
    "time_split_fixed",
    RANGES.format(
        f"""SELECT pickup_hour, CASE WHEN pickup_hour < TIMESTAMP '{TEST[0]}' THEN 'train'
        ELSE 'test' END AS part FROM model_rows WHERE pickup_hour >= TIMESTAMP '{TRAIN[0]}'
        AND pickup_hour < TIMESTAMP '{TEST[1]}'"""
    ),
)
def _(t):
    return e.split_ranges(*e.time_split_fixed(t.model_rows, TRAIN, TEST))


@check(
    "latest_k_months",
    """SELECT DISTINCT calendar_month FROM known_history ORDER BY calendar_month DESC LIMIT 4""",
)
def _(t):
    return e.latest_k_months(p.dropna_features(p.historical_profile_features(t.monthly_demand)))


@check(
    "persistence_baseline",
    """SELECT "LocationID", pickup_hour, demand, CAST(lag_24h AS DOUBLE) AS prediction
    FROM model_rows""",
)
def _(t):
    return e.persistence_baseline(t.model_rows).select(
        "LocationID", "pickup_hour", "demand", "prediction"
    )


BASELINE = """SELECT "LocationID", pickup_hour, calendar_month, demand,
    greatest(zone_dow_hour_mean, 0) AS prediction FROM known_history"""


def baseline_rows(t):
    history = p.dropna_features(p.historical_profile_features(t.monthly_demand))
    return e.profile_baseline(history)


@check("profile_baseline", BASELINE)
def _(t):
    rows = baseline_rows(t).withColumn("prediction", F.round("prediction", 6))
    return rows.select("LocationID", "pickup_hour", "calendar_month", "demand", "prediction")


# Two models per month: the profile baseline and the mean of the zone and hour.
BOTH = """SELECT 'zone_dow_hour_mean' AS model, calendar_month, demand,
      greatest(zone_dow_hour_mean, 0) AS prediction FROM known_exact
    UNION ALL SELECT 'zone_hour_mean', calendar_month, demand, zone_hour_mean FROM known_exact"""
MAE, RMSE = "AVG(abs(demand - prediction))", "sqrt(AVG((demand - prediction) * (demand - prediction)))"


def two_models(t):
    rows = baseline_rows(t)
    wide = rows.withColumn("prediction", F.col("zone_hour_mean"))
    shown = ["calendar_month", "demand", "prediction"]
    return rows.select(F.lit(PROFILE_MODEL).alias("model"), *shown).unionAll(
        wide.select(F.lit("zone_hour_mean"), *shown)
    )


def rounded_errors(metrics):
    return metrics.withColumns({"mae": F.round("mae", 5), "rmse": F.round("rmse", 5)})


@check(
    "regression_metrics",
    f"""SELECT model, calendar_month, ROUND({MAE}, 5) AS mae, ROUND({RMSE}, 5) AS rmse
    FROM ({BOTH}) GROUP BY 1, 2""",
)
def _(t):
    return rounded_errors(e.regression_metrics(two_models(t), "model", "calendar_month"))


@check(
    "select_production_model",
    f"""SELECT model, ROUND({MAE}, 5) AS mae, ROUND({RMSE}, 5) AS rmse
    FROM ({BOTH}) GROUP BY 1 ORDER BY mae, rmse, model LIMIT 1""",
)
def _(t):
    return e.select_production_model(rounded_errors(e.regression_metrics(two_models(t), "model")))


@check(
    "model_leaderboard",
    f"""SELECT model, ROUND(mae, 2) AS mae, ROUND(rmse, 2) AS rmse,
    CASE WHEN row_number() OVER (ORDER BY mae, rmse, model) = 1 THEN 'Production'
    ELSE 'Candidate' END AS status
    FROM (SELECT model, {MAE} AS mae, {RMSE} AS rmse FROM ({BOTH}) GROUP BY 1)""",
)
def _(t):
    return e.model_leaderboard(e.regression_metrics(two_models(t), "model"))


# --- Trained models ---------------------------------------------------------------------


@lru_cache(maxsize=2)
def full_run(t):
    """The forest of the full settings on the grid of the whole monthly demand, fitted once."""
    return hist.train_historical(demand_grid_features(t))


@lru_cache(maxsize=2)
def full_backtest(t):
    """The backtest of all candidates with their full settings, done once."""
    return fut.rolling_backtest(t.monthly_demand)


def demand_grid_features(t):
    """Stored features of all months on the complete grid of the observed zones.

    The demand is counted once and stored: span, zones and grid read the counts, not the rows behind them.
    """
    counted = t.folder("demand")
    sink_overwrite(t.monthly_demand, counted)
    demand = t.spark.read.parquet(counted)
    span = demand.agg(F.min("pickup_hour").alias("first"), F.max("pickup_hour").alias("last")).first()
    zones = demand.select("LocationID").distinct()
    grid = complete_grid(demand, zones, str(span["first"]), str(span["last"]))
    root = t.folder("features")
    sink_months(demand_features(grid), root, "pickup_hour")
    return t.spark.read.parquet(root)


@check(
    "assemble_features",
    f"""SELECT "LocationID", pickup_hour,
    [{", ".join(f"CAST({c} AS DOUBLE)" for c in HISTORICAL_FEATURES)}] AS feature_values
    FROM model_rows""",
)
def _(t):
    assembled = hist.assemble_features(t.model_rows)
    values = F.transform(vector_to_array("features_vector"), lambda x: F.round(x, 6))
    return assembled.select("LocationID", "pickup_hour", values.alias("feature_values"))


@check(
    "zone_encoding",
    f"""SELECT "LocationID", pickup_hour,
    [{", ".join(f"ROUND(CAST({c} AS DOUBLE), 6)" for c in FUTURE_FEATURES)}] AS feature_values,
    CAST(1 AS DOUBLE) AS zone_marks FROM known_history""",
)
def _(t):
    rows = p.dropna_features(p.historical_profile_features(t.monthly_demand))
    encoded = Pipeline(stages=fut.zone_encoding()).fit(rows).transform(rows)
    known = len(FUTURE_FEATURES)
    values = vector_to_array("features")
    plain = F.transform(F.slice(values, 1, known), lambda x: F.round(x, 6))
    marks = F.aggregate(
        F.slice(values, known + 1, F.size(values)), F.lit(0.0), lambda total, x: total + x
    )
    return encoded.select(
        "LocationID", "pickup_hour", plain.alias("feature_values"), marks.alias("zone_marks")
    )


@check("train_historical_rf")
def _(t):
    return full_run(t).predictions


@check("historical_model_metrics")
def _(t):
    return f.historical_model_metrics(full_run(t).metrics)


@check("feature_importance")
def _(t):
    return full_run(t).importance


@check("feature_importance_ranked")
def _(t):
    return f.feature_importance_ranked(full_run(t).importance)


SUM_VALUES = ["1", *FUTURE_FEATURES, "demand"]


# Sums of products of six-digit numbers may end in a tie, which a shift of no short decimal keeps away from rounding.
SHIFT = 0.0000333333333


@check(
    "backtest_sums",
    f"""SELECT CAST(calendar_month AS VARCHAR) AS calendar_month, "LocationID",
        {", ".join(f'ROUND(SUM(CAST({SUM_VALUES[i]} AS DOUBLE) * {SUM_VALUES[j]}) + {SHIFT}, 2) + 0.0 AS {sums.pair_name(i, j)}' for i, j in sums.PAIRS)}
    FROM known_history GROUP BY calendar_month, "LocationID\"""",
)
def _(t):
    rows = rounded(p.dropna_features(p.historical_profile_features(t.monthly_demand)))
    found = sums.month_sums(rows).withColumn("calendar_month", F.col("calendar_month").cast("string"))
    names = [sums.pair_name(*pair) for pair in sums.PAIRS]
    return found.select("calendar_month", "LocationID", *[(F.round(F.col(c) + SHIFT, 2) + 0.0).alias(c) for c in names])


@check("linear_backtest")
def _(t):
    rows = p.dropna_features(p.historical_profile_features(t.monthly_demand))
    return sums.linear_backtest(rows, fut.backtest_months(rows), LINEAR_SETTINGS["regParam"])


@check("candidate_models")
def _(t):
    rows = p.dropna_features(p.historical_profile_features(t.monthly_demand)).withColumn(
        "demand", F.col("demand").cast("double")
    )
    scored = None
    for name, candidate in fut.candidate_models().items():
        predicted = e.clipped(candidate.fit(rows).transform(rows)).select(
            F.lit(name).alias("model"), "demand", "prediction"
        )
        scored = predicted if scored is None else scored.unionAll(predicted)
    return e.regression_metrics(scored, "model")


@check("rolling_backtest")
def _(t):
    return full_backtest(t).detail


# What the trained candidates share: the holdout months, and how many rows they train and test on.
@check(
    "backtest_months",
    f"""WITH months AS (SELECT DISTINCT calendar_month FROM known_history ORDER BY 1 DESC LIMIT {BACKTEST_MONTHS})
    SELECT model, CAST(calendar_month AS VARCHAR) AS test_month,
    (SELECT COUNT(*) FROM known_history k WHERE k.calendar_month < months.calendar_month) AS train_rows,
    (SELECT COUNT(*) FROM known_history k WHERE k.calendar_month = months.calendar_month) AS test_rows
    FROM months, (SELECT unnest(['{PROFILE_MODEL}', 'linear_regression', 'random_forest',
    'gradient_boosted_trees']) AS model)""",
)
def _(t):
    rows = fut.backtest_rows(t.monthly_demand)
    folds = fut.backtest_folds(rows, fut.backtest_months(rows))
    return folds.withColumn("test_month", F.col("test_month").cast("string"))


@check(
    "backtest_baseline",
    f"""SELECT CAST(calendar_month AS VARCHAR) AS test_month, ROUND({MAE}, 5) AS mae, ROUND({RMSE}, 5) AS rmse
    FROM (SELECT calendar_month, demand, greatest(zone_dow_hour_mean, 0) AS prediction FROM known_exact)
    WHERE calendar_month IN (SELECT DISTINCT calendar_month FROM known_exact ORDER BY 1 DESC
    LIMIT {BACKTEST_MONTHS}) GROUP BY 1""",
)
def _(t):
    rows = fut.backtest_rows(t.monthly_demand)
    errors = fut.baseline_backtest(rows, fut.backtest_months(rows))
    return rounded_errors(errors).select(F.col("test_month").cast("string"), "mae", "rmse")


@check(
    "feature_importance_sum",
    f"SELECT {len(HISTORICAL_FEATURES)}::BIGINT AS features, 1.0::DOUBLE AS total, true AS in_range",
)
def _(t):
    return full_run(t).importance.agg(
        F.count_distinct("feature").alias("features"),
        F.round(F.sum("importance"), 6).alias("total"),
        F.every(F.col("importance").between(0, 1)).alias("in_range"),
    )


@check("future_model_metrics")
def _(t):
    return f.future_model_metrics(full_backtest(t).summary)


@check("future_profiles_trained")
def _(t):
    return fut.future_profiles(t.monthly_demand, "random_forest")


# --- Forecasts --------------------------------------------------------------------------


@check(
    "future_profiles",
    "SELECT * REPLACE (ROUND(predicted_demand, 6) AS predicted_demand) FROM profile",
)
def _(t):
    return rounded(fut.future_profiles(t.monthly_demand))


@check(
    "forecast_metadata",
    """SELECT 'zone_dow_hour_mean' AS production_model,
    (SELECT MAX(pickup_hour) FROM monthly_demand) AS trained_through,
    ['LocationID', 'month', 'day_of_week', 'hour'] AS profile_dimensions,
    COUNT(*) AS profile_rows FROM profile""",
)
def _(t):
    profile = fut.future_profiles(t.monthly_demand)
    stamped = fut.forecast_metadata(t.monthly_demand, profile, PROFILE_MODEL)
    return f.forecast_metadata(stamped).drop("generated_at")


# A profile with holes, so that every fallback level occurs: one zone lacks whole months, one
# keeps a single weekday, one has only night hours, one is a single slot.
HOLES = """NOT (location_id = 1 AND month > 6) AND NOT (location_id = 2 AND day_of_week <> 3)
    AND NOT (location_id = 3 AND hour > 5)
    AND NOT (location_id = 4 AND (month <> 1 OR day_of_week <> 1 OR hour <> 0))"""
CUT = "2000-01-01 00:00:00"
LOOKUP = f"""SELECT request_id, location_id, forecast_datetime,
    ROUND(COALESCE(exact, month_hour, at_hour, in_zone), 6) AS predicted_demand,
    CASE WHEN exact IS NOT NULL THEN 'zone_dow_hour_mean'
      WHEN month_hour IS NOT NULL THEN 'month_hour_fallback'
      WHEN at_hour IS NOT NULL THEN 'hour_fallback' ELSE 'zone_fallback' END AS forecast_method,
    TIMESTAMP '{CUT}' AS trained_through
    FROM (SELECT r.*, x.predicted_demand AS exact, m.v AS month_hour, h.v AS at_hour, z.v AS in_zone
      FROM (SELECT * FROM {{requests}}) AS r
      JOIN (SELECT location_id, AVG(predicted_demand) AS v FROM holey GROUP BY 1) AS z
        ON r.location_id = z.location_id
      LEFT JOIN holey AS x ON r.location_id = x.location_id
        AND month(r.forecast_datetime) = x.month AND hour(r.forecast_datetime) = x.hour
        AND dayofweek(r.forecast_datetime) + 1 = x.day_of_week
      LEFT JOIN (SELECT location_id, month, hour, AVG(predicted_demand) AS v FROM holey
        GROUP BY 1, 2, 3) AS m ON r.location_id = m.location_id
        AND month(r.forecast_datetime) = m.month AND hour(r.forecast_datetime) = m.hour
      LEFT JOIN (SELECT location_id, hour, AVG(predicted_demand) AS v FROM holey GROUP BY 1, 2) AS h
        ON r.location_id = h.location_id AND hour(r.forecast_datetime) = h.hour
      WHERE r.forecast_datetime > TIMESTAMP '{CUT}')"""
HOLEY = f"(SELECT * FROM profile WHERE {HOLES})"


def _lookup_sql(requests: str) -> str:
    return LOOKUP.replace("{requests}", requests).replace("FROM holey", f"FROM {HOLEY}").replace(
        "JOIN holey", f"JOIN {HOLEY}"
    )


def lookup(t, requests, **options):
    path = t.folder("profile")
    sink_overwrite(fut.future_profiles(t.monthly_demand).where(HOLES), path)
    profile = t.spark.read.parquet(path)
    cut = F.expr(f"TIMESTAMP_NTZ '{CUT}'")
    return rounded(f.forecast_lookup_batch(requests, profile, cut, PROFILE_MODEL, **options))


@check("forecast_lookup_batch", _lookup_sql("requests"))
def _(t):
    return lookup(t, t.requests)


# Every third request asks for one slot, and no zone is broadcast as a whole.
CROWD = """SELECT request_id, CASE WHEN request_id % 3 = 0 THEN 1 ELSE location_id END AS location_id,
    CASE WHEN request_id % 3 = 0 THEN TIMESTAMP '2001-05-07 09:00:00' ELSE forecast_datetime END
      AS forecast_datetime FROM requests"""


@check("forecast_lookup_crowded", _lookup_sql(f"({CROWD})"))
def _(t):
    third = F.col("request_id") % 3 == 0
    crowded = t.requests.withColumns(
        {
            "location_id": F.when(third, 1).otherwise(F.col("location_id")),
            "forecast_datetime": F.when(third, F.expr("TIMESTAMP_NTZ '2001-05-07 09:00:00'")).otherwise(
                F.col("forecast_datetime")
            ),
        }
    )
    return lookup(t, crowded, broadcast_rows=0)


# The same requests as instants in UTC, answered on New York clocks.
@check(
    "forecast_lookup_zoned",
    _lookup_sql(
        """(SELECT request_id, location_id, ((forecast_datetime AT TIME ZONE 'UTC')
        AT TIME ZONE 'America/New_York') AS forecast_datetime FROM requests)"""
    ),
)
def _(t):
    zoned = t.requests.withColumn("forecast_datetime", F.col("forecast_datetime").cast("timestamp"))
    return lookup(t, zoned)


@check(
    "future_profile_lookup",
    f"""SELECT COUNT(*) AS profile_rows,
    ROUND(MAX(CASE WHEN month = 9 AND day_of_week = 1 AND hour = 3 THEN predicted_demand END), 6)
      AS exact_demand,
    ROUND(AVG(CASE WHEN month = 9 AND hour = 3 THEN predicted_demand END), 6) AS month_hour_demand,
    ROUND(AVG(CASE WHEN hour = 3 THEN predicted_demand END), 6) AS hour_demand,
    ROUND(AVG(predicted_demand), 6) AS zone_demand FROM {HOLEY} WHERE location_id = 3""",
)
def _(t):
    profile = fut.future_profiles(t.monthly_demand).where(HOLES)
    found = f.future_profile_lookup(profile, 3, month=9, day_of_week=1, hour=3)
    return found.select("profile_rows", *[F.round(c, 6).alias(c) for c in found.columns[1:]])


PREDICTIONS = """SELECT "LocationID", pickup_hour, demand AS actual_demand,
    CAST(lag_24h AS DOUBLE) AS predicted_demand FROM model_rows"""


@check("join_predictions_zones", f'{PREDICTIONS} JOIN zones USING ("LocationID")')
def _(t):
    return hist.join_predictions_zones(e.persistence_baseline(t.model_rows), t.zones)


@check(
    "historical_predictions",
    f"""SELECT p.*, "Borough", "Zone", service_zone FROM ({PREDICTIONS}) AS p
    JOIN zones USING ("LocationID") WHERE "LocationID" = 17
    AND CAST(pickup_hour AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
)
def _(t):
    served = hist.join_predictions_zones(e.persistence_baseline(t.model_rows), t.zones)
    stored = served.withColumnRenamed("LocationID", "location_id")
    return f.historical_predictions(stored, t.dim_zone, 17, date(2024, 1, 10), date(2024, 1, 20))

