"""Spark-native analytics operators over DataFrames and streams."""
