"""Spark-native time-lapse object analytics."""
