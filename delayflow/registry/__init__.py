"""Registered queries: each operator run over the test tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from delayflow.registry.tables import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MODULES = [
    "scalars", "projections", "lookups", "joins", "summaries", "ordering", "sources", "learning",
    "streams", "jobs",
]


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``key``; ``sql`` gives the same rows from the same tables."""

    def register(function: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"registered twice: {key}")
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return function

    return register


def load() -> None:
    """Import all modules that register queries."""
    for name in MODULES:
        import_module(f"delayflow.registry.{name}")
