"""Spark-native analytics over time-ordered episode data."""

__version__ = "0.1.0"
