"""Spark-native engine for comparative population genomics."""

__version__ = "0.1.0"
