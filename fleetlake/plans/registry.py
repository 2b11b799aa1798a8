"""Registered queries: one Spark builder and (where SQL can express it) one
DuckDB oracle per operator of the survey inventory.

Every builder reads the driver tables under ``sf_dir`` (or tables Spark
derives from them in ``fleetlake.sources.fixtures``) and returns a lazy
DataFrame over the whole input.  Float aggregates whose value depends on
summation order are rounded to 6 places in both engines so the
order-insensitive value hash is stable; everything else is exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: add a builder (and its oracle SQL) under ``name``."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


def load_all() -> None:
    """Import the modules whose import registers queries."""
    from fleetlake.plans import (  # noqa: F401
        queries,
        queries_drift,
        queries_linkage,
        queries_kept,
        queries_misc,
        queries_orders,
        queries_tests,
        queries_validate,
    )
