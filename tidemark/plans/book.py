"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function of (spark, sf_dir) under its name, with DuckDB SQL for the same rows where there is one."""

    def add(f: Query) -> Query:
        if f.__name__ in QUERIES:
            raise ValueError(f"{f.__name__} is registered twice")
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a task that nests them in lists.
TASK_ROWS = 500_000


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a table by key into as many tasks as their number asks for, so a task that lists the rows of its keys needs
    the same memory whatever the table's size."""
    return rows.repartition(rows.count() // TASK_ROWS + 1, *keys)
