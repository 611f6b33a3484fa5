"""Spark-native preparation, profiling, selection and scoring of person-level tables."""

__version__ = "0.1.0"
