"""Incremental rebuilds over streams."""
