"""Registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query of (spark, sf_dir), and the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register
