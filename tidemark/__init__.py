"""Spark-native engine for leakage-safe time-series analytics on large tables."""
