"""Every operator as a query on the driver tables, with its SQL form where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function (spark, folder) -> DataFrame and the equivalent SQL."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def load() -> None:
    """Import the modules that register queries."""
    from wattweave.registry import column_queries, energy, folds, joining, measured_models  # noqa: F401
    from wattweave.registry import rolling, searching, tables  # noqa: F401
