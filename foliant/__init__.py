"""Spark-native analytics over document data."""
