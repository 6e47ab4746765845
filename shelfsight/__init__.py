"""Retail outlet demand analytics as Spark DataFrame functions."""

__version__ = "0.1.0"
