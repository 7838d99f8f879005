"""Spark-native sales series and forecasting engine."""

__version__ = "0.1.0"
