"""Spark ML models: the historical forest and the selection of a future-demand model."""
