"""Bid-log warehouse operators: counts, top client per city, key profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions import timefmt, user_agent

ATTRS = ("device", "os", "browser")


def city_value_counts(bids: DataFrame, attr: str) -> DataFrame:
    """COUNT(attr) per (cityid, attr) straight from bids.

    Bids are first counted per (cityid, useragent) (map-side partial
    aggregation), so the user-agent rules run once per distinct pair instead
    of once per bid.  The attribute is never NULL (unknown -> "Unknown"), so
    summing the pair counts equals COUNT(attr).
    """
    pre = bids.groupBy("cityid", "useragent").agg(F.count(F.lit(1)).alias("n"))
    return (user_agent.enrich(pre).groupBy("cityid", attr)
            .agg(F.sum("n").cast("bigint").alias("cnt")))


def top_per_city(counts: DataFrame, attr: str) -> DataFrame:
    """Rank-1 value per city by count (ties: smallest value first).

    ``row_number() ... = 1`` becomes a WindowGroupLimit, so each task keeps
    only its best row per city before the window exchange.
    """
    w = Window.partitionBy("cityid").orderBy(F.desc("cnt"), F.asc(attr))
    return (counts.withColumn("rnk", F.row_number().over(w))
            .where(F.col("rnk") == 1).drop("rnk"))


def joinback(view: DataFrame, counts: DataFrame, attr: str) -> DataFrame:
    """Each detail row with its group's count (u JOIN d ON cityid, attr).

    Spark broadcasts the aggregate side by its size in bytes, else splits a skewed city.
    """
    return view.join(counts, ["cityid", attr], "inner")


def profile_counts(bids: DataFrame) -> DataFrame:
    """(cityid, device, os, browser) -> n with the user agent parsed once per
    distinct (cityid, useragent) instead of once per bid."""
    pre = bids.groupBy("cityid", "useragent").agg(F.count(F.lit(1)).alias("n"))
    return (user_agent.enrich(pre)
            .groupBy("cityid", *ATTRS).agg(F.sum("n").alias("n")))


def city_top_values(bids: DataFrame) -> DataFrame:
    """(cityid, kind, value, cnt) for the rank-1 value of each attribute."""
    combos = profile_counts(bids)
    per_attr = (combos
                .select("cityid", F.inline(F.array(*[
                    F.struct(F.lit(a).alias("kind"), F.col(a).alias("value"), F.col("n").alias("n"))
                    for a in ATTRS])))
                .groupBy("cityid", "kind", "value").agg(F.sum("n").alias("cnt")))
    w = Window.partitionBy("cityid", "kind").orderBy(F.desc("cnt"), F.asc("value"))
    return (per_attr.withColumn("rnk", F.row_number().over(w))
            .where(F.col("rnk") == 1).drop("rnk"))


def city_top_profile(bids: DataFrame, cities: DataFrame) -> DataFrame:
    """name, device, os, browser: the dominant client of every city.

    One scan, user agents parsed after a (cityid, useragent) pre-aggregate,
    one ranking over the three attributes at once, then a pivot; cities
    (a dimension) join by ``try_cast`` so a malformed city id never raises.
    """
    top = city_top_values(bids)
    wide = top.groupBy("cityid").agg(*[
        F.max(F.when(F.col("kind") == a, F.col("value"))).alias(a) for a in ATTRS])
    wide = wide.where(F.col("device").isNotNull() & F.col("os").isNotNull() & F.col("browser").isNotNull())
    c = cities.select("id", "name")
    return (wide.join(c, F.col("cityid").try_cast("int") == F.col("id"), "inner")
            .select("name", *ATTRS))


def with_bid_date(bids: DataFrame) -> DataFrame:
    return bids.withColumn("bid_date", timefmt.bid_date(F.col("ts")))


def distribution(bids: DataFrame, col: str) -> DataFrame:
    """COUNT(*) per value of one column (partial aggregation absorbs hot values)."""
    return bids.groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))


PROFILE_KEYS = ("ip", "regionid", "advertiserid", "adexchange", "publicdomain", "bid_date")


def partition_key_profile(bids: DataFrame, keys: tuple[str, ...] = PROFILE_KEYS) -> DataFrame:
    """Per candidate key: distinct values and min / exact median / max / total rows per value.

    All keys in one pass: each bid is unpivoted into (key_name, value) and
    counted with map-side partial aggregation.  The exact median never
    gathers a key's values in one task: it is read off the histogram of
    per-value counts (at most ~sqrt(2 * rows) distinct counts per key).
    """
    b = with_bid_date(bids) if "bid_date" in keys and "bid_date" not in bids.columns else bids
    pairs = b.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("key_name"), F.col(k).cast("string").alias("value")) for k in keys])))
    per_value = pairs.groupBy("key_name", "value").agg(F.count(F.lit(1)).alias("rows"))
    hist = per_value.groupBy("key_name", "rows").agg(F.count(F.lit(1)).alias("freq"))
    w = Window.partitionBy("key_name").orderBy("rows").rowsBetween(Window.unboundedPreceding, 0)
    wk = Window.partitionBy("key_name")
    h = (hist.withColumn("cum", F.sum("freq").over(w))
         .withColumn("n_values", F.sum("freq").over(wk)))
    lo_pos = F.floor((F.col("n_values") + 1) / 2)      # 1-based middle positions
    hi_pos = F.floor(F.col("n_values") / 2) + 1
    covers = lambda pos: (F.col("cum") - F.col("freq") < pos) & (pos <= F.col("cum"))
    return (h.groupBy("key_name").agg(
        F.first("n_values").alias("n_values"),
        F.min("rows").alias("min_rows"),
        ((F.max(F.when(covers(lo_pos), F.col("rows"))) + F.max(F.when(covers(hi_pos), F.col("rows")))) / 2.0)
        .cast("double").alias("median_rows"),
        F.max("rows").alias("max_rows"),
        F.sum(F.col("rows") * F.col("freq")).cast("bigint").alias("total_rows"))
        .withColumn("n_values", F.col("n_values").cast("bigint")))
