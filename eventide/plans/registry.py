"""Named queries over the stored tables, each with an optional DuckDB oracle.

A query is a function ``(spark, sf_dir) -> DataFrame``; ``@query`` records it
together with ANSI SQL that computes the same rows on the same parquet files
(the views ``events``, ``orders``, ... are registered by the checker).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco
