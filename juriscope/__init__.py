"""Spark-native analytics for legal documents."""
