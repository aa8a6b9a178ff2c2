"""Registry behind ``__spark_entry__.queries()`` / ``oracle_sql()``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query over the driver tables, with its oracle SQL (None = rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    # Importing the catalog modules fills the registry.
    from sensorlake.plans import (catalog_agg, catalog_core, catalog_drops, catalog_funcs, catalog_io,  # noqa: F401
                                 catalog_model, catalog_quality, catalog_stream)
