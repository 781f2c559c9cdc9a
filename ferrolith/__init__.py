"""Spark-native analytics operators, jobs and streams."""
