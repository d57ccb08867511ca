"""Registry of the queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function under its own name (or ``name``); ``sql`` is the DuckDB form of the same result."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            CHECKS[key] = sql.strip()
        return fn

    return register
