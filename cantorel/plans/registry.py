"""Registration of queries with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cantorel import session

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, folder) as a query; the package is sent to the workers before it runs."""

    def add(f: Query) -> Query:
        def run(spark: SparkSession, d: str) -> DataFrame:
            session.ship(spark)
            return f(spark, d)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")
