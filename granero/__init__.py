"""Granero: supply-programme analytics as Spark DataFrame jobs."""
