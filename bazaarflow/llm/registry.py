"""Queries of the subpackage with SQL for comparison, None where SQL cannot express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def registered(sql: str | None = None):
    """Register a query under its function name."""

    def keep(run):
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return keep
