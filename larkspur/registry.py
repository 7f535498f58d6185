"""Registered queries (Spark) and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver's tables (or data Spark derives from them).  Every oracle re-derives
the same fixture from the raw tables independently, in DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from larkspur.plans import queries_hashtags  # noqa: F401
    from larkspur.plans import queries_bids  # noqa: F401
    from larkspur.plans import queries_bookings  # noqa: F401
    from larkspur.plans import queries_incremental  # noqa: F401
    from larkspur.streaming import queries_stream  # noqa: F401
