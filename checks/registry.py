"""The list of queries; each is a function of (spark, sf_dir), with SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query under a name; covers lists the inventory entries it shows."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = fn
        COVERS[name] = covers
        if sql is not None:
            SQL[name] = sql
        return fn

    return add
