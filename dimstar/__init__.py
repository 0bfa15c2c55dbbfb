"""Dimensional sales-force analytics as Spark DataFrame jobs."""
