"""Where queries and their SQL are put down side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        """Register a query; without SQL it is held against brute force in the tests."""

        def add(f):
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return add


query = Registry()
