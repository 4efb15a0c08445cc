"""Registration of queries together with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL for its result where one exists."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            CHECK_SQL[name] = sql
        return run

    return register


def rounded(column: Column | str, places: int = 4) -> Column:
    """Rounded double without a negative zero; in SQL: ``round(x, places) + 0.0``."""
    return F.round(column, places) + F.lit(0.0)
