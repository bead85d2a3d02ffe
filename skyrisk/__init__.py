"""Skyrisk: daily weather and danger-level analytics expressed as Spark DataFrames."""

__version__ = "0.1.0"
