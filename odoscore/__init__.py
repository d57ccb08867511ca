"""Spark-native telemetry analytics and customer-churn scoring."""

__version__ = "0.1.0"
