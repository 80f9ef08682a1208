"""Spark-native satellite image time series engine."""
