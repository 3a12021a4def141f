"""Declarative lakehouse operators for PySpark: dictionaries in, DataFrames out."""

__version__ = "0.1.0"
