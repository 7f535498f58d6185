"""Mergeable sketches of partition sizes: a profile for any range of days from one small row per day.

If the log is partitioned by day and a candidate key, its partitions are the (day, value) pairs.  Per day and key
a row keeps a quantile sketch of the pairs' sizes and a distinct sketch of the values; the rows
of any days merge into the profile of their range.  A new day reads that day only.  The exact form is
``bids.partition_key_profile``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators.bids import PROFILE_KEYS, with_bid_date

QUANTILE_K = 400             # normalised rank error about 0.7 %
DISTINCT_LG_K = 13           # relative error about 1 %


def _pairs(bids: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(bid_date, key_name, value, rows): the sizes of the partitions by day and key."""
    b = bids if "bid_date" in bids.columns else with_bid_date(bids)
    kinds = F.inline(F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(k).cast("string").alias("value")) for k in keys]))
    return b.select("bid_date", kinds).groupBy("bid_date", "key_name", "value").agg(F.count(F.lit(1)).alias("rows"))


def day_sketches(bids: DataFrame, keys: tuple[str, ...] = PROFILE_KEYS) -> DataFrame:
    """(bid_date, key_name, sizes, vals, min_rows, max_rows, total_rows): one row per day and key."""
    return (_pairs(bids, keys).groupBy("bid_date", "key_name").agg(
        F.kll_sketch_agg_bigint("rows", QUANTILE_K).alias("sizes"),
        F.hll_sketch_agg(F.coalesce("value", F.lit("")), DISTINCT_LG_K).alias("vals"),
        F.min("rows").alias("min_rows"), F.max("rows").alias("max_rows"), F.sum("rows").alias("total_rows")))


def range_profile(sketches: DataFrame) -> DataFrame:
    """Profile per key over the days of ``sketches``: partitions, n_values (estimate), min, median (estimate), max and total rows."""
    merged = sketches.groupBy("key_name").agg(
        F.kll_merge_agg_bigint("sizes", QUANTILE_K).alias("sizes"), F.hll_union_agg("vals").alias("vals"),
        F.min("min_rows").alias("min_rows"), F.max("max_rows").alias("max_rows"), F.sum("total_rows").cast("bigint").alias("total_rows"))
    return merged.select(
        "key_name", F.kll_sketch_get_n_bigint("sizes").alias("partitions"), F.hll_sketch_estimate("vals").alias("n_values"),
        "min_rows", F.kll_sketch_get_quantile_bigint("sizes", F.lit(0.5)).alias("median_rows"), "max_rows", "total_rows", "sizes")


def exact_profile(bids: DataFrame, keys: tuple[str, ...] = PROFILE_KEYS) -> DataFrame:
    """The histogram of partition sizes, with the share of partitions below and up to each size: what the sketch's ranks are held against."""
    from pyspark.sql import Window
    hist = _pairs(bids, keys).groupBy("key_name", "rows").agg(F.count(F.lit(1)).alias("freq"))
    by_size, of_key = Window.partitionBy("key_name").orderBy("rows"), Window.partitionBy("key_name")
    upto = F.sum("freq").over(by_size) / F.sum("freq").over(of_key)
    return hist.select("key_name", "rows", (upto - F.col("freq") / F.sum("freq").over(of_key)).alias("below"), upto.alias("upto"))
