"""Registered queries over stored state that is brought up to date piece by piece."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur.operators import bids as ops
from larkspur.operators import sketches
from larkspur.plans import clustered, queries_bids, queries_bookings, ua_dictionary
from larkspur.plans.city_partials import CityPartials
from larkspur.plans.queries_bids import BIDS_SQL, bids
from larkspur.plans.split_partials import SplitPartials
from larkspur.registry import register
from larkspur.session import scratch_path

RELOADED = ("2013-10-20", "2013-10-24")


@register("couples_split_rerun", f"WITH {queries_bookings._LINES_SQL} SELECT market_key, cnt FROM counts")
def couples_split_rerun(spark, sf_dir):
    """Partial counts per file block, some of the blocks read twice; the later rows of a block replace its earlier ones."""
    path = queries_bookings.stored_lines(spark, sf_dir)
    partials = SplitPartials(spark, scratch_path(spark, "split-partials"))
    partials.load(path)
    partials.load(path, F.pmod(F.xxhash64("file", "block"), F.lit(3)) == 0)
    return partials.counts()


@register("ua_dictionary_enrich", f"WITH {BIDS_SQL} SELECT bidid, device, os, browser FROM bids")
def ua_dictionary_enrich(spark, sf_dir):
    """Bids enriched from a dictionary that was filled by one day first; the other days parse only what that day lacked."""
    b = ops.with_bid_date(bids(spark, sf_dir)).select("bidid", "useragent", "bid_date")
    root = scratch_path(spark, "ua-dictionary")
    ua_dictionary.refresh(spark, root, b.where(F.col("bid_date") == RELOADED[0]))
    ua_dictionary.refresh(spark, root, b)
    return ua_dictionary.enrich(b, root).select("bidid", "device", "os", "browser")


_TOP_SQL = " UNION ALL ".join(
    f"SELECT cityid, '{a}' AS kind, {a} AS value, cnt FROM ({queries_bids._top_sql(a)})" for a in ops.ATTRS)


@register("city_top_incremental", f"WITH {BIDS_SQL} {_TOP_SQL}")
def city_top_incremental(spark, sf_dir):
    """Top clients after all days were loaded, two of them wrongly (a third of their bids), and those two loaded again."""
    b = ops.with_bid_date(bids(spark, sf_dir)).select("bidid", "cityid", "useragent", "bid_date")
    reloaded = F.col("bid_date").isin(*RELOADED)
    store = CityPartials(spark, scratch_path(spark, "city-partials"))
    store.load(b.where(~reloaded | (F.pmod(F.xxhash64("bidid"), F.lit(3)) == 0)))
    store.load(b.where(reloaded))
    return store.top()


_PAIRS_SQL = " UNION ALL ".join(
    f"SELECT '{k}' AS key_name, CAST({k} AS VARCHAR) AS value, bid_date, count(*) AS rows FROM bd GROUP BY {k}, bid_date"
    for k in ops.PROFILE_KEYS)


@register("partition_sketch_profile", f"""WITH {BIDS_SQL}, pv AS ({_PAIRS_SQL})
SELECT key_name, count(*) AS partitions, min(rows) AS min_rows, max(rows) AS max_rows, CAST(sum(rows) AS BIGINT) AS total_rows,
       true AS median_close, true AS values_close
FROM pv GROUP BY key_name""")
def partition_sketch_profile(spark, sf_dir):
    """Profile of all days merged from one stored sketch row per day and key; its estimates are held against the exact figures:
    the median's rank within 2 %, the number of values within 4 %."""
    b = ops.with_bid_date(bids(spark, sf_dir)).select("bid_date", *[k for k in ops.PROFILE_KEYS if k != "bid_date"])
    path = scratch_path(spark, "day-sketches")
    sketches.day_sketches(b).write.parquet(path)
    profile = sketches.range_profile(spark.read.parquet(path)).drop("sizes")
    exact = sketches.exact_profile(b).withColumnRenamed("rows", "median_rows")
    values = ops.partition_key_profile(b).select("key_name", F.col("n_values").alias("exact_values"))
    close = (F.col("below") <= 0.52) & (F.col("upto") >= 0.48)
    near = F.abs(F.col("n_values") - F.col("exact_values")) <= 0.04 * F.col("exact_values")
    return (profile.join(exact, ["key_name", "median_rows"], "left").join(values, "key_name")
            .select("key_name", "partitions", "min_rows", "max_rows", "total_rows",
                    F.coalesce(close, F.lit(False)).alias("median_close"), near.alias("values_close")))


CLUSTER_FILES = 32
CLUSTER_RANGES = {"cityid": ("7", "7"), "bid_date": ("2013-10-21", "2013-10-22")}


@register("bids_clustered_lookup", f"""WITH {BIDS_SQL}
SELECT bidid, cityid, useragent, bid_date FROM bd WHERE cityid = '7' AND bid_date BETWEEN '2013-10-21' AND '2013-10-22'""")
def bids_clustered_lookup(spark, sf_dir):
    """Rows of a city and two days from a layout clustered on city, user agent and day; files without any are not opened."""
    b = ops.with_bid_date(bids(spark, sf_dir)).select("bidid", "cityid", "useragent", "bid_date")
    path = scratch_path(spark, "bids-clustered")
    clustered.write_clustered(b, path, ("cityid", "useragent", "bid_date"), CLUSTER_FILES)
    return clustered.read_clustered(spark, path, b.schema, CLUSTER_RANGES)
