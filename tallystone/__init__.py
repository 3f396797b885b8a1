"""Spark-native analytics engine for wealth-management data."""
