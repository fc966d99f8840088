"""Spark-native operators for price history."""
