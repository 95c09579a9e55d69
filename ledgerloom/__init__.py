"""Layered retail analytics as Spark DataFrame operators and jobs."""
