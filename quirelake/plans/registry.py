"""Registering queries with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Named queries and, where SQL can express them, their SQL for DuckDB."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        def register(function: Query) -> Query:
            self.queries[function.__name__] = function
            if sql is not None:
                self.sql[function.__name__] = sql
            return function

        return register
