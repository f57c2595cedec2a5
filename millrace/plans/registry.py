"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, if SQL can express it, its oracle."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return add
