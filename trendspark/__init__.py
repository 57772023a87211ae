"""Spark-native analytics over recurring snapshots of trending content."""

__version__ = "0.1.0"
