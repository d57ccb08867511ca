"""Registry of the queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function under ``name``; ``sql`` is the DuckDB form of the same result."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql.strip()
        return fn

    return register
