"""Registry behind the query catalogue: ``register`` records a Spark query
and, where one exists, its DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# computed doubles are rounded to this many places on both sides
DIGITS = 6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def with_views(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
