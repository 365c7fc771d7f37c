"""Registered queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query; ``sql`` may start with further CTEs after the named views."""

    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            text = sql.strip()
            if views:
                lead = with_views(*views)
                text = f"{lead}{'' if text.startswith(',') else chr(10)}{text}"
            ORACLES[name] = text
        return query

    return register
