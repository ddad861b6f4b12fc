"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries of one module: name -> callable, and name -> DuckDB SQL where SQL can state the result."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracle: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            if f.__name__ in self.queries:
                raise ValueError(f"query {f.__name__} is there already")
            self.queries[f.__name__] = f
            if sql:
                self.oracle[f.__name__] = sql
            return f

        return add
