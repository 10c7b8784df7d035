"""A book of queries: functions of tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from provlake.session import load

Tables = Callable[[str], DataFrame]


class Book:
    def __init__(self):
        self.functions: dict[str, Callable[[Tables], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def keep(f: Callable[[Tables], DataFrame]):
            self.functions[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return keep

    def queries(self) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
        return {k: (lambda spark, d, f=f: f(lambda name: load(spark, d, name))) for k, f in self.functions.items()}

    def oracle_sql(self) -> dict[str, str]:
        return dict(self.sql)
