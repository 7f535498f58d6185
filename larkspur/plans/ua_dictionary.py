"""A stored dictionary of parsed user agents: each string is parsed once per version of the rules.

User agents repeat over days; what a day brings new is a small part of its distinct strings.
``refresh`` finds it by an anti join with the dictionary, parses only that, and appends it under the
version of the rule tables.  After a change of the rules everything counts as unseen again.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import user_agent
from larkspur.plans.archive import _exists

ATTRS = ("device", "os", "browser")
SCHEMA = "useragent string, device string, os string, browser string, rules string"


def rules_version() -> str:
    """A digest of the rule tables."""
    return sha256(repr((user_agent.BROWSER_RULES, user_agent.OS_RULES)).encode()).hexdigest()[:16]


def read(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """(useragent, device, os, browser) under the current rules.

    A writer that failed while it moved its files may have left some: its strings are in the dictionary
    then, and the next refresh adds the others.
    """
    if not _exists(spark, root):
        return spark.createDataFrame([], SCHEMA).drop("rules")
    rows = spark.read.schema(SCHEMA).parquet(root)
    return rows.where(F.col("rules") == (version or rules_version())).drop("rules")


def refresh(spark: SparkSession, root: str, rows: DataFrame, ua_col: str = "useragent") -> int:
    """Add the user agents of ``rows`` that the dictionary lacks; how many were parsed."""
    met = rows.select(F.col(ua_col).alias("useragent")).where(F.col("useragent").isNotNull()).distinct()
    unseen = met.join(read(spark, root).select("useragent"), "useragent", "left_anti")
    before = read(spark, root).count()
    (user_agent.enrich(unseen).select("useragent", *ATTRS).withColumn("rules", F.lit(rules_version())).hint("rebalance")
     .write.mode("append").partitionBy("rules").parquet(root))
    return read(spark, root).count() - before


def enrich(rows: DataFrame, root: str, ua_col: str = "useragent") -> DataFrame:
    """``rows`` with device, os and browser looked up; a string that is null or not in the dictionary is unknown.

    Spark broadcasts the dictionary by its size, else splits the partition of a hot string.
    """
    known = read(rows.sparkSession, root).withColumnRenamed("useragent", "__ua")
    joined = rows.join(known, F.col(ua_col) == F.col("__ua"), "left").drop("__ua")
    return joined.withColumns({a: F.coalesce(F.col(a), F.lit(user_agent.UNKNOWN)) for a in ATTRS})
