"""Spark-native analytics over debate-record style data."""
