"""Columns to spell alike: dates as text, decimals and nullable integers as doubles, lists joined."""

TEXTS: dict[str, str] = {
    "trip_calendar_columns": "pickup_date",
    "business_trips": "pickup_date",
    "optional_date_filter": "pickup_date",
    "upsert_by_key": "pickup_date",
    "upsert_some_columns": "pickup_date",
    "insert_if_absent": "pickup_date",
    "zone_hour_daily": "date",
    "dim_date": "full_date",
    "fact_demand": "pickup_date",
    "fact_trips": "pickup_date",
    "join_fact_zone": "pickup_date",
    "join_fact_payment": "pickup_date",
    "join_fact_hour": "pickup_date",
    "join_fact_date": "pickup_date",
    "validate_fact_trips": "min_date max_date",
    "demand_date_range": "min_date max_date",
    "zone_demand_over_time": "date",
    "demand_over_time": "pickup_hour",
    "demand_over_time_bounded": "pickup_hour",
    "daily_resample": "pickup_hour",
    "zone_kpis": "peak_date",
    "revenue_over_time": "pickup_date",
    "month_partials": "calendar_month",
    "profile_store_partials": "calendar_month",
    "month_partials_zone": "calendar_month",
    "month_partials_zone_hour": "calendar_month",
    "expanding_profiles": "calendar_month",
    "profile_store_expanding": "calendar_month",
    "join_profiles": "calendar_month",
    "historical_profile_features": "calendar_month",
    "dropna_subset": "calendar_month",
    "latest_k_months": "calendar_month",
    "profile_baseline": "calendar_month",
    "regression_metrics": "calendar_month",
    "sink_zone_hour_daily": "date",
    "keyed_table_upsert": "pickup_date",
    "keyed_table_some_columns": "pickup_date",
    "keyed_table_new_keys": "pickup_date",
    "day_rank_summaries": "period",
    "stored_rank_summaries": "period",
}
DOUBLES: dict[str, str] = {
    "clean_trips": "DOLocationID passenger_count RatecodeID",
    "clean_trips_shuffled": "DOLocationID passenger_count RatecodeID",
    "correction_groups": "DOLocationID",
    "business_predicate": "DOLocationID",
    "project_demand_fields": "DOLocationID",
    "all_null_group": "DOLocationID",
    "extreme_records_distance": "DOLocationID",
    "sort_keys": "DOLocationID",
    "distinct_rows": "DOLocationID passenger_count RatecodeID",
    "lag_features": "lag_1h lag_24h lag_168h",
    "demand_features": "lag_1h lag_24h lag_168h",
    "demand_features_in_slices": "lag_1h lag_24h lag_168h",
    "fact_trips": "fare_amount total_amount tip_amount trip_distance tolls_amount "
    "congestion_surcharge airport_fee cbd_congestion_fee",
    "join_fact_payment": "fare_amount total_amount tip_amount trip_distance tolls_amount "
    "congestion_surcharge airport_fee cbd_congestion_fee",
    "keyed_table_some_columns": "capacity",
    "duplicate_groups": "DOLocationID",
}
LISTS: dict[str, str] = {
    "duplicate_groups": "fare_amounts total_amounts",
    "assemble_features": "feature_values",
    "zone_encoding": "feature_values",
    "forecast_metadata": "profile_dimensions",
}
