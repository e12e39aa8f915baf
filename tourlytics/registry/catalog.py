"""Collects the registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def load() -> None:
    from . import checking, events, ingest, journeys, layout, monitoring, snapshots, spatial, streams, tables  # noqa: F401
    from . import ordering  # noqa: F401  # builds on the SQL of the others
