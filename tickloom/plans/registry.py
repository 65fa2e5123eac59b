"""Registered queries: name, Spark callable, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if check is not None:
            SQL[name] = check
        return fn
    return add


def load() -> None:
    from tickloom.plans import (  # noqa: F401 - importing registers
        catalog_queries, market_queries, record_queries, reference_queries, stream_queries,
        symbology_queries, text_queries,
    )
