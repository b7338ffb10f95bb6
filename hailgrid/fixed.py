"""Fixed values that results depend on: column names, code tables, thresholds, settings."""

# --- Trip files -------------------------------------------------------------------------
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
# Monthly files are named by this prefix, the year and the month.
TRIP_FILE_PREFIX = "yellow_tripdata_"

# One physical trip is recognised by these six columns.
TRIP_KEY = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
]

# Required columns of a trip file and the kind of type each must have.
REQUIRED_TRIP_COLUMNS = {
    "VendorID": "integer",
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
    "PULocationID": "integer",
    "DOLocationID": "integer",
    "payment_type": "integer",
    "trip_distance": "numeric",
    "fare_amount": "numeric",
    "total_amount": "numeric",
    "tip_amount": "numeric",
    "tolls_amount": "numeric",
    "congestion_surcharge": "numeric",
    "Airport_fee": "numeric",
    "cbd_congestion_fee": "numeric",
}
OPTIONAL_TRIP_COLUMNS = [
    "passenger_count",
    "RatecodeID",
    "store_and_fwd_flag",
    "extra",
    "mta_tax",
    "improvement_surcharge",
]
# Columns that are empty together on one kind of record.
JOINTLY_EMPTY_COLUMNS = [
    "passenger_count",
    "RatecodeID",
    "store_and_fwd_flag",
    "congestion_surcharge",
    "Airport_fee",
]
# Columns that demand counting needs.
DEMAND_COLUMNS = TRIP_KEY + ["fare_amount", "total_amount"]
# Components a total is made of.
TOTAL_COMPONENTS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "Airport_fee",
    "cbd_congestion_fee",
]

# --- Zones ------------------------------------------------------------------------------
ZONE_COLUMNS = ["LocationID", "Borough", "Zone", "service_zone"]
ZONE_LOOKUP_DDL = "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"
AIRPORT_SERVICE_ZONE = "Airports"

# --- Business rules ---------------------------------------------------------------------
BUSINESS_PAYMENT_TYPES = [1, 2, 3, 4, 5]
MAX_SPEED_MPH = 100
MAX_FARE_PER_MILE = 100
CREDIT_CARD = 1
PAYMENT_METHODS = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
# Measures of the revenue fact table: output name, trip column.
FACT_MEASURES = [
    ("fare_amount", "fare_amount"),
    ("total_amount", "total_amount"),
    ("tip_amount", "tip_amount"),
    ("trip_distance", "trip_distance"),
    ("tolls_amount", "tolls_amount"),
    ("congestion_surcharge", "congestion_surcharge"),
    ("airport_fee", "Airport_fee"),
    ("cbd_congestion_fee", "cbd_congestion_fee"),
]
# Distance bands: upper bound (exclusive), order, label.
DISTANCE_BANDS = [
    (2, 1, "0-2 miles"),
    (5, 2, "2-5 miles"),
    (10, 3, "5-10 miles"),
    (20, 4, "10-20 miles"),
    (None, 5, "20+ miles"),
]
# Parts of the day: last hour, label.
DAY_PARTS = [(5, "Night"), (11, "Morning"), (17, "Afternoon"), (23, "Evening")]

# --- Features ---------------------------------------------------------------------------
LAG_HOURS = [1, 24, 168]
ROLLING_HOURS = [24, 168]
HISTORY_HOURS = 168
HISTORICAL_FEATURES = [
    "hour",
    "day_of_week",
    "day_of_month",
    "is_weekend",
    "hour_sin",
    "hour_cos",
    "dow_sin",
    "dow_cos",
    "lag_1h",
    "lag_24h",
    "lag_168h",
    "rolling_mean_24h",
    "rolling_mean_168h",
]
CALENDAR_FEATURES = [
    "hour",
    "day_of_week",
    "month",
    "is_weekend",
    "hour_sin",
    "hour_cos",
    "dow_sin",
    "dow_cos",
    "month_sin",
    "month_cos",
]
PROFILE_FEATURES = ["zone_mean_demand", "zone_hour_mean", "zone_dow_hour_mean"]
FUTURE_FEATURES = CALENDAR_FEATURES + PROFILE_FEATURES

# --- Models -----------------------------------------------------------------------------
PERSISTENCE_MODEL = "24h Persistence Baseline"
HISTORICAL_MODEL = "Random Forest"
PROFILE_MODEL = "zone_dow_hour_mean"
BACKTEST_MONTHS = 4
FOREST_SETTINGS = {"numTrees": 100, "maxDepth": 10, "seed": 42}
LINEAR_SETTINGS = {"regParam": 0.1, "elasticNetParam": 0.0, "maxIter": 50}
BOOSTED_SETTINGS = {"maxIter": 50, "maxDepth": 6, "stepSize": 0.1, "seed": 42}
FORECAST_TIME_ZONE = "America/New_York"
FALLBACK_METHODS = ["month_hour_fallback", "hour_fallback", "zone_fallback"]

# --- Quantile reports: probabilities ----------------------------------------------------
DURATION_QUANTILES = [0.01, 0.25, 0.50, 0.75, 0.95, 0.99]
DISTANCE_QUANTILES = [0.01, 0.25, 0.50, 0.75, 0.95, 0.99, 0.999]
AMOUNT_QUANTILES = [0.50, 0.90, 0.95, 0.99, 0.995, 0.999]
UPPER_TAIL_QUANTILES = [0.99, 0.995, 0.999, 0.9999]
RATIO_QUANTILES = [0.50, 0.90, 0.95, 0.99, 0.999, 0.9999]
MONEY_COLUMNS = ["fare_amount", "total_amount", "tip_amount", "trip_distance"]
