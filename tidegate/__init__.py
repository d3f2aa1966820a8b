"""Spark-native operators for wholesale-network operations data."""

__version__ = "0.1.0"
