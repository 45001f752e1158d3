"""Spark-native analytics: sources."""
