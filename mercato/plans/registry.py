"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with SQL twins.

Every query reads the given tables through the fixture adapter (or data
Spark derives from them) and runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

def query(name: str, sql: str | None = None):
    """Register a query builder and (optionally) its DuckDB oracle SQL. The
    plan is built on every call."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from mercato.plans import queries_core  # noqa: F401
    from mercato.plans import queries_feeds  # noqa: F401
    from mercato.plans import queries_audit  # noqa: F401
    from mercato.plans import queries_io  # noqa: F401
