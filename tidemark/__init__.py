"""Hydrologic time-series analytics as Spark DataFrame jobs."""
