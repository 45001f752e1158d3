"""Spark-native analytics: operators."""
