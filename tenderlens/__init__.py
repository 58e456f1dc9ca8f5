"""Audit analytics for public works contracts, written as lazy Spark jobs."""

__version__ = "0.1.0"
