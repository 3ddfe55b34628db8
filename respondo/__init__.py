"""Spark-native engine for open-ended survey answers."""

__version__ = "0.1.0"
