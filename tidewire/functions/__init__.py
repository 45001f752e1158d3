"""Spark-native analytics: functions."""
