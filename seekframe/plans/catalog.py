"""All named queries of the library, each with the DuckDB SQL that checks it where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function of (spark, sf_dir) under its own name, with its SQL."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def load() -> None:
    """Import the modules that register the queries."""
    from seekframe.plans import catalog_analytics, catalog_facets, catalog_filters, catalog_indexing, catalog_search  # noqa: F401
