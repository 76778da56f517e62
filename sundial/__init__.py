"""Subscriber feature engine: point-in-time feature tables as plain Spark DataFrame jobs."""
