"""Registration of queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bindings import Bindings, duck_sql

Query = Callable[[Bindings], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query over the bindings; without SQL it is checked by tests alone."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return register


def runnable(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: fn(Bindings(spark, folder))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: runnable(fn) for name, fn in QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: duck_sql(text) for name, text in SQL.items()}
