"""Spark-native analytics for large collections of long-form documents."""
