"""Tidewell: DataFrame -> DataFrame analytics operators for Spark."""

__version__ = "0.1.0"
