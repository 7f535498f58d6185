"""Time expressions.  The session time zone is UTC (see session.configure)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the data model.
STATUS_TIME_FORMAT = "EEE MMM dd HH:mm:ss Z yyyy"   # e.g. "Mon Jan 01 00:00:07 +0000 2024"
BID_TS_FORMAT = "yyyyMMddHHmmssSSS"


def epoch_seconds(ts: Column) -> Column:
    """timestamp / timestamp_ntz -> epoch seconds (bigint)."""
    return F.unix_seconds(ts.cast("timestamp"))


def epoch_date(epoch: Column) -> Column:
    return F.from_unixtime(epoch, "yyyy-MM-dd")


def epoch_hour(epoch: Column) -> Column:
    """Zero padded hour of day ("09")."""
    return F.from_unixtime(epoch, "HH")


def format_status_time(ts: Column) -> Column:
    return F.date_format(ts.cast("timestamp"), STATUS_TIME_FORMAT)


def parse_status_time(s: Column) -> Column:
    """Parse "EEE MMM d HH:mm:ss Z yyyy"; NULL when malformed.

    Spark 3+ datetime patterns cannot parse the weekday name, so the first
    four characters ("Mon ") are skipped; the weekday is implied by the date.
    """
    return F.try_to_timestamp(F.substring(s, 5, 64), F.lit("MMM d HH:mm:ss Z yyyy"))


def format_bid_ts(ts: Column) -> Column:
    return F.date_format(ts.cast("timestamp"), BID_TS_FORMAT)


def bid_date(ts_text: Column) -> Column:
    """'yyyyMMddHHmmssSSS' text -> 'yyyy-MM-dd'; NULL when unparseable.

    The millisecond part is ignored (adjacent-digit patterns with SSS do not
    parse in Spark 4); it cannot change the date.
    """
    parsed = F.try_to_timestamp(F.substring(ts_text, 1, 14), F.lit("yyyyMMddHHmmss"))
    return F.date_format(parsed, "yyyy-MM-dd")
