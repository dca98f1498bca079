"""Registered queries over the given tables, with the SQL each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def case(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL for its result where there is one."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def load_all() -> None:
    from sluice.cases import access, files, ingest, monitor, slices, streams, xml  # noqa: F401
