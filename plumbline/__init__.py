"""Spark-native screening analytics."""
