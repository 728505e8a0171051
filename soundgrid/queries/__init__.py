"""Every operator as a query over the star-schema tables, with the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Register a query under its function's name, and its SQL."""

    def keep(f: Callable) -> Callable:
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLES[key] = sql
        return f

    return keep


from soundgrid.queries import catalog, charting, extras, partitions, serving, surfaces  # noqa: E402, F401
