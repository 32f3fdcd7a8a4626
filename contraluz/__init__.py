"""Procurement-integrity analytics as Spark DataFrame pipelines."""

__version__ = "0.1.0"
