"""Stemma: a PySpark-native engine for lexicographic and corpus data."""

__version__ = "0.1.0"
