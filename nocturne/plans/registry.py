"""All queries by name, and their DuckDB equivalents where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its own name, with its SQL if there is one."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


from . import image_queries, sky_queries, text_queries  # noqa: E402, F401
