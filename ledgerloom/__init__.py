"""Spark-native operators for claims, file catalogues, listings, banking and telemetry."""

__version__ = "0.1.0"
