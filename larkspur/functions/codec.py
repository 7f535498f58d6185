"""Delimited stats records exchanged between the two stream stages.

Wire form: key ``date;hour`` and value ``date;hour;hashtag;cnt``.  Decoding
splits at the *last* ``;`` so a hashtag that contains ``;`` survives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELIM = ";"


def encode(stats: DataFrame) -> DataFrame:
    """(date, hour, hashtag, cnt) -> (key, value)."""
    d, h, t = (F.coalesce(F.col(c), F.lit("")) for c in ("date", "hour", "hashtag"))
    return stats.select(F.concat_ws(DELIM, d, h).alias("key"),
                        F.concat_ws(DELIM, d, h, t, F.col("cnt").cast("string")).alias("value"))


def stat_key(value: Column) -> Column:
    """Everything before the last delimiter (``date;hour;hashtag``)."""
    return F.regexp_extract(value, r"(?s)^(.*);[^;]*$", 1)


def stat_count(value: Column) -> Column:
    return F.substring_index(value, DELIM, -1).try_cast("bigint")


def decode(records: DataFrame) -> DataFrame:
    """(key, value) -> (stat_key, cnt); malformed values drop."""
    v = F.col("value").cast("string")
    return (records.select(stat_key(v).alias("stat_key"), stat_count(v).alias("cnt"))
            .where(F.col("cnt").isNotNull() & (F.col("stat_key") != "")))


def decode_columns(records: DataFrame) -> DataFrame:
    """(key, value) -> (date, hour, hashtag, cnt); the hashtag keeps any ``;``."""
    d = decode(records)
    parts = F.split(F.col("stat_key"), DELIM, 3)
    return d.select(F.get(parts, 0).alias("date"), F.get(parts, 1).alias("hour"), F.get(parts, 2).alias("hashtag"), "cnt")


def rollup(decoded: DataFrame) -> DataFrame:
    """Per-batch sum of counts by stat key (no state across batches)."""
    return decoded.groupBy("stat_key").agg(F.sum("cnt").cast("bigint").alias("cnt"))
