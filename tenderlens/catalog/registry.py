"""Registration of queries with the SQL text that states their result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry(dict[str, tuple[Query, str]]):
    """Queries by name."""

    def query(self, sql: str) -> Callable[[Query], Query]:
        """Decorator that registers a function under its own name."""

        def register(function: Query) -> Query:
            self[function.__name__] = (function, sql)
            return function

        return register
