"""Registry of checked queries: a Spark callable and its SQL twin under one name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return add


def ctes(**parts: str) -> str:
    """``WITH`` list from name -> body, in order."""
    return "WITH " + ",\n".join(f"{n} AS ({b.strip()})" for n, b in parts.items()) + "\n"
