"""Named queries: each a function of (session, folder of tables), some with the same query in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(f: Query) -> Query:
            assert name not in self.queries, name
            self.queries[name] = f
            if sql is not None:
                self.sql[name] = sql
            return f

        return keep
