"""Registration of named queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import read_table

Query = Callable[[SparkSession, str], DataFrame]


class Catalogue:
    """Queries by name. A query takes a function that reads tables by name."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        """Register a query under its function's name; `sql` is what DuckDB must agree with."""

        def register(build: Callable[[Callable[[str], DataFrame]], DataFrame]):
            def query(spark: SparkSession, sf_dir: str) -> DataFrame:
                return build(lambda name: read_table(spark, sf_dir, name))

            query.__name__ = build.__name__
            self.queries[build.__name__] = query
            if sql is not None:
                self.sql[build.__name__] = sql
            return build

        return register


#: White space as `functions.text.strip` takes it off, for DuckDB's regular expressions.
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
TOKENS = "('', 'NA', 'NaN', 'nan', 'None', 'NULL', 'null', 'N/A', '#N/A', '<NA>')"
FILLERS = "('', '#N/A', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'Name: 0, dtype: object', 'None', 'merged', 'nan', 'null')"


def stripped(c: str) -> str:
    return rf"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"
