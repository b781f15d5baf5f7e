"""Harrier: a PySpark-native engine for monitoring text corpora."""
