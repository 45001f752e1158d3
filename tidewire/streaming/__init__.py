"""Spark-native analytics: streaming."""
