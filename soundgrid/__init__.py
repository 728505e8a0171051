"""Layered-grid analytics as Spark DataFrame operations."""
