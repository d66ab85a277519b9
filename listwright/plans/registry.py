"""Named queries over the driver tables, with DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, dates: str = "") -> Callable[[Query], Query]:
    """Register a query under its function's name. Columns in dates are given as ISO texts."""
    names = dates.split()

    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.withColumns({c: df[c].cast("string") for c in names}) if names else df

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in names)}) FROM ({sql}) AS q" if names else sql
        return f

    return add


from . import boards, changes, features, health, keys, pages, stored  # noqa: E402, F401  they register themselves
