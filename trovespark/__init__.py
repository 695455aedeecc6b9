"""Spark-native retrieval, evidence and evaluation engine."""

__version__ = "0.1.0"
