"""Gleaner: a PySpark-native engine for turning fetched documents into typed, scored records."""

__version__ = "0.1.0"
