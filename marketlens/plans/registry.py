"""Registration of queries with their SQL and the operators they stand for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Registry:
    """Queries of one module by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}
        self.operators: dict[str, list[str]] = {}

    def query(self, operators: str, sql: str | None = None):  # noqa: ANN201
        """Registers a function of ``t``, where ``t(name)`` gives a table of the data directory."""

        def register(f):  # noqa: ANN001, ANN202
            from marketlens.session import table

            def run(spark: SparkSession, d: str) -> DataFrame:
                return f(lambda name: table(spark, d, name))

            run.__name__, run.__doc__ = f.__name__, f.__doc__
            self.queries[f.__name__] = run
            self.operators[f.__name__] = operators.split()
            if sql:
                self.sql[f.__name__] = sql
            return run

        return register
