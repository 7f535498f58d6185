"""Catalog objects of the warehouse: a database with its location, tables and views."""

from __future__ import annotations

import re
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from larkspur.functions import user_agent

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


@contextmanager
def temporary_database(spark: SparkSession, prefix: str, location: str):
    """A new database, current for the block, dropped with all it holds afterwards."""
    name = ensure_database(spark, f"{prefix}_{uuid.uuid4().hex[:10]}", location)
    try:
        with using_database(spark, name):
            yield name
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def ensure_database(spark: SparkSession, name: str, location: str) -> str:
    """CREATE DATABASE IF NOT EXISTS with an explicit (shared) location."""
    if not _IDENT.match(name):
        raise ValueError(f"bad database name {name!r}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return name


class using_database:
    """``USE db`` for a block, restoring the previous current database."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.prev = spark, name, None

    def __enter__(self):
        self.prev = self.spark.catalog.currentDatabase()
        self.spark.catalog.setCurrentDatabase(self.name)
        return self

    def __exit__(self, *exc):
        self.spark.catalog.setCurrentDatabase(self.prev)
        return False


@contextmanager
def user_agents_view(spark: SparkSession, bids: DataFrame):
    """Names of a parsed user-agent view and its source view for a block (SQL form).

    ``parse_ua`` is a SQL table function (inlined into the plan), applied with a LATERAL join.  View
    and function names are new for each block and dropped afterwards; a frame made from the view is
    already resolved and outlives it.
    """
    tag = uuid.uuid4().hex[:10]
    source, view, fn = f"bids_ext_{tag}", f"user_agents_{tag}", f"parse_ua_{tag}"
    try:
        user_agent.register_sql_function(spark, fn)
        bids.createOrReplaceTempView(source)
        spark.sql(f"CREATE TEMPORARY VIEW {view} AS SELECT b.*, ua.device, ua.os, ua.browser "
                  f"FROM {source} b, LATERAL {fn}(b.useragent) ua")
        yield view
    finally:
        spark.catalog.dropTempView(view)
        spark.catalog.dropTempView(source)
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {fn}")
