"""Spark-native engine for many demand time series keyed by (series_id, ts)."""
