"""Hotels for couples: market counts, stored partials, top/bottom markets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY_DELIM = "#"
TOP_N = 3


def market_key(continent, country, market):
    return F.concat_ws(KEY_DELIM, F.coalesce(continent, F.lit("")), F.coalesce(country, F.lit("")),
                       F.coalesce(market, F.lit("")))


def market_counts(couples: DataFrame) -> DataFrame:
    """continent#country#market -> count; the all-empty key "##" is dropped."""
    key = market_key(F.col("continent"), F.col("country"), F.col("market"))
    return (couples.select(key.alias("market_key"))
            .where(F.col("market_key") != KEY_DELIM * 2)
            .groupBy("market_key").agg(F.count(F.lit(1)).alias("cnt")))


def partial_counts(lines_with_split: DataFrame, couples_of) -> DataFrame:
    """Per input split (file) partial counts, as ``key,count`` text lines."""
    c = couples_of(lines_with_split)
    key = market_key(F.col("continent"), F.col("country"), F.col("market"))
    return (c.select("split", key.alias("market_key"))
            .where(F.col("market_key") != KEY_DELIM * 2)
            .groupBy("split", "market_key").agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.concat_ws(",", "market_key", F.col("cnt").cast("string")).alias("value")))


def merge_partials(partial_lines: DataFrame) -> DataFrame:
    """Sum stored ``key,count`` lines per key (split at the first comma)."""
    kv = F.split(F.col("value"), ",", 2)
    return (partial_lines.select(kv[0].alias("market_key"), F.get(kv, 1).try_cast("bigint").alias("cnt"))
            .where(F.col("cnt").isNotNull())
            .groupBy("market_key").agg(F.sum("cnt").cast("bigint").alias("cnt")))


def top_markets(counts: DataFrame, n: int = TOP_N, ascending: bool = False) -> DataFrame:
    """n markets by count (ties by key).  ``ascending=True`` keeps the least booked."""
    order = F.asc("cnt") if ascending else F.desc("cnt")
    return counts.orderBy(order, F.asc("market_key")).limit(n)


def result_lines(top: DataFrame) -> DataFrame:
    return top.select(F.concat_ws(" : ", "market_key", F.col("cnt").cast("string")).alias("line"))
