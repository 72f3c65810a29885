"""Spark-native loading, categorization and analytics of bank transactions."""

__version__ = "0.1.0"
