"""Spark-native analytics: plans."""
