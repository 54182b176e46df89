"""Query registry: a Spark callable per name and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register the function under its own (or the given) name, with its SQL if it has one."""
    def register(build: Query) -> Query:
        known_as = name or build.__name__
        if known_as in QUERIES:
            raise ValueError(f"query {known_as} is registered twice")
        QUERIES[known_as] = build
        if sql is not None:
            ORACLES[known_as] = sql
        return build

    return register
