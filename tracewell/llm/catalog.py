"""Queries of this subpackage and their SQL twins."""

from __future__ import annotations

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    """Register a query, and its DuckDB twin where SQL can express it."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
