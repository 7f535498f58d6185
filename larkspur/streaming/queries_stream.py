"""Family B: streaming hashtag jobs, run as bounded (availableNow) streams.

The "topic" is a folder of Parquet record files in time order in the shared folder,
written from the ``events``-derived status records; each query runs to the
end of the available input, in several micro-batches limited in bytes, and returns its sink read back as a batch frame.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from larkspur.functions import codec
from larkspur.plans.delta_log import DeltaLog
from larkspur.plans.sqlfix import STATUS_TAGS
from larkspur.registry import register
from larkspur.session import scratch_path
from larkspur.sources import topic, topic_files
from larkspur.sources.tables import table
from larkspur.sources.topic import RECORD_SCHEMA
from larkspur.streaming import hashtag_stream as hs

TOPIC_FILES = 16
# The registered queries limit a micro-batch to this share of the topic's bytes, so that they have several at any scale.
BATCHES = 4
# How far the topic may be out of order between two micro-batches: its files are in time order.
SLICE_DELAY = "1 hour"
# Control record: a status far in the future without hashtags; it only moves
# event time forward so the last open windows close.
SENTINEL_VALUE = '{"created_at":"Fri Jan 01 00:00:00 +0000 2100","entities":{"hashtags":[]}}'
SENTINEL_TIME = 4102444800

_COUNTS_SQL = f"""WITH {STATUS_TAGS}
SELECT date, hour, hashtag, count(*) AS cnt FROM tags GROUP BY date, hour, hashtag"""


def write_topic(spark: SparkSession, sf_dir: str, where=None, path: str | None = None, files: int = TOPIC_FILES) -> str:
    """Publish status records as Parquet files under a topic folder, in time order: one scan, one shuffle by time range."""
    path = path or scratch_path(spark, "topic")
    events = topic_files.in_time_order(table(spark, sf_dir, "events", parallel=False), files, "ts", "event_id")
    rec = topic.status_records(events)
    topic_files.publish(rec if where is None else rec.where(where), path)
    return path


def _share(spark: SparkSession, path: str) -> int:
    return 1 + topic_files.size_in_bytes(spark, path) // BATCHES


def _control(spark: SparkSession, path: str) -> None:
    topic_files.publish(spark.createDataFrame([("control", SENTINEL_VALUE, "statuses", 0, -1, SENTINEL_TIME, 0)], RECORD_SCHEMA), path)


def record_stream(spark: SparkSession, path: str):
    return hs.record_stream(spark, path, max_bytes=_share(spark, path))


@register("stream_hashtag_deltas", _COUNTS_SQL)
def stream_hashtag_deltas(spark, sf_dir):
    path = write_topic(spark, sf_dir)
    out, ckpt = scratch_path(spark, "s1-records"), scratch_path(spark, "ckpt")
    hs.run(hs.arrival_deltas(record_stream(spark, path), out, ckpt))
    return hs.decoded_totals(spark, out)


@register("stream_hashtag_windows", f"""WITH {STATUS_TAGS}
SELECT strftime(time_bucket(INTERVAL '3 minutes', date_trunc('second', ts)), '%Y-%m-%d %H:%M:%S') AS window_start,
       hashtag, count(*) AS cnt
FROM tags GROUP BY 1, 2""")
def stream_hashtag_windows(spark, sf_dir):
    path = write_topic(spark, sf_dir)
    out, ckpt = scratch_path(spark, "s-windows"), scratch_path(spark, "ckpt")
    # The control record moves event time past every open window; the batch after it writes them.
    _control(spark, path)
    hs.run(hs.event_windows(record_stream(spark, path), out, ckpt, delay=SLICE_DELAY))
    return spark.read.schema("window_start string, hashtag string, cnt bigint").parquet(out)


# Arrival stamps of the registered query: the topic's month arrives within six minutes.
ARRIVAL_START, ARRIVAL_SPEED, ARRIVAL_BATCH = 1704067200, 7200, 10


@register("stream_arrival_windows", f"""WITH {STATUS_TAGS}
SELECT strftime(to_timestamp(a - a % 180) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS window_start,
       date, hour, hashtag, count(*) AS cnt
FROM (SELECT *, {ARRIVAL_START} + (CAST(epoch(date_trunc('second', ts)) AS BIGINT) - {ARRIVAL_START}) // {ARRIVAL_SPEED} AS a FROM tags)
GROUP BY 1, date, hour, hashtag""")
def stream_arrival_windows(spark, sf_dir):
    """3-minute windows of arrival time, fed by files of ten seconds of arrivals each, three to a micro-batch."""
    path = scratch_path(spark, "topic")
    events = table(spark, sf_dir, "events", parallel=False).withColumn("arrived", ARRIVAL_START + F.floor(
        (F.unix_seconds(F.col("ts").cast("timestamp")) - ARRIVAL_START) / ARRIVAL_SPEED))
    slices = 30 * 86400 // ARRIVAL_SPEED // ARRIVAL_BATCH
    ordered = topic_files.in_time_order(events.withColumn("slice", F.floor(F.col("arrived") / ARRIVAL_BATCH)), slices, "slice")
    arrival = ARRIVAL_START + F.floor((F.col("timestamp") - ARRIVAL_START) / ARRIVAL_SPEED)
    topic_files.publish(topic.status_records(ordered).withColumn("timestamp", arrival), path)
    _control(spark, path)
    out, ckpt = scratch_path(spark, "s-arrival"), scratch_path(spark, "ckpt")
    hs.run(hs.arrival_windows(hs.record_stream(spark, path, max_files=3), out, ckpt))
    return spark.read.schema("window_start string, date string, hour string, hashtag string, cnt bigint").parquet(out)


@register("stream_hashtag_totals", _COUNTS_SQL)
def stream_hashtag_totals(spark, sf_dir):
    path = write_topic(spark, sf_dir)
    out, ckpt = scratch_path(spark, "s-totals"), scratch_path(spark, "ckpt")
    hs.run(hs.running_totals(record_stream(spark, path), out, ckpt, delay=SLICE_DELAY))
    return hs.latest_totals(spark, out, ckpt)


def _two_stage(spark, sf_dir) -> str:
    path = write_topic(spark, sf_dir)
    s1, s2 = scratch_path(spark, "s1-records"), scratch_path(spark, "s2-rollup")
    hs.run(hs.arrival_deltas(record_stream(spark, path), s1,
                             scratch_path(spark, "ckpt")))
    hs.run(hs.rollup_stage(hs.stats_record_stream(spark, s1, max_bytes=_share(spark, s1)), s2, scratch_path(spark, "ckpt")))
    return s2


@register("stream_delta_rollup", f"""WITH {STATUS_TAGS}
SELECT date || ';' || hour || ';' || hashtag AS stat_key, count(*) AS cnt FROM tags GROUP BY date, hour, hashtag""")
def stream_delta_rollup(spark, sf_dir):
    return hs.sum_of_deltas(spark, _two_stage(spark, sf_dir))


@register("stream_two_stage", _COUNTS_SQL)
def stream_two_stage(spark, sf_dir):
    totals = hs.sum_of_deltas(spark, _two_stage(spark, sf_dir))
    parts = F.split(F.col("stat_key"), codec.DELIM, 3)
    return totals.select(F.get(parts, 0).alias("date"), F.get(parts, 1).alias("hour"), F.get(parts, 2).alias("hashtag"), "cnt")


@register("stream_restart", _COUNTS_SQL)
def stream_restart(spark, sf_dir):
    """Stop after the first topic partitions, restart from the checkpoint when the rest arrives."""
    path = write_topic(spark, sf_dir, where=F.col("partition") != 2)
    out, ckpt = scratch_path(spark, "s1-records"), scratch_path(spark, "ckpt")
    hs.run(hs.arrival_deltas(record_stream(spark, path), out, ckpt))
    write_topic(spark, sf_dir, where=F.col("partition") == 2, path=path)
    hs.run(hs.arrival_deltas(record_stream(spark, path), out, ckpt))
    return hs.decoded_totals(spark, out)


@register("stream_crash_recovery", _COUNTS_SQL)
def stream_crash_recovery(spark, sf_dir):
    """Totals after a crash before a micro-batch is written, another after one has been, and two restarts."""
    path = write_topic(spark, sf_dir)
    out, ckpt = scratch_path(spark, "s-totals"), scratch_path(spark, "ckpt")
    with hs.changelog_state(spark):
        for batch, after in ((1, False), (2, True)):
            try:
                hs.run(hs.running_totals(record_stream(spark, path), out, ckpt, delay=SLICE_DELAY, wrap=hs.crash_in(batch, after)))
            except StreamingQueryException as e:
                if "injected crash" not in str(e):
                    raise
            else:
                raise RuntimeError(f"the query did not reach batch {batch}")
        hs.run(hs.running_totals(record_stream(spark, path), out, ckpt, delay=SLICE_DELAY))
        return hs.latest_totals(spark, out, ckpt)


@register("stream_timed_run", _COUNTS_SQL)
def stream_timed_run(spark, sf_dir):
    """A continuous query stopped after a bounded time, then the rest of the topic."""
    path = write_topic(spark, sf_dir)
    out, ckpt = scratch_path(spark, "s1-records"), scratch_path(spark, "ckpt")
    hs.run(hs.arrival_deltas(record_stream(spark, path), out, ckpt, bounded=False, interval="0 seconds"), timeout_s=1.5)
    hs.run(hs.arrival_deltas(record_stream(spark, path), out, ckpt))
    return hs.decoded_totals(spark, out)


@register("stream_archive_merge", _COUNTS_SQL)
def stream_archive_merge(spark, sf_dir):
    path = write_topic(spark, sf_dir)
    root, ckpt = scratch_path(spark, "s-archive"), scratch_path(spark, "ckpt")
    hs.run(hs.archive_merge(record_stream(spark, path), root, ckpt))
    return DeltaLog(spark, root).read()


@register("stream_archive_hours", f"""WITH {STATUS_TAGS}
SELECT date, hour, hashtag, count(*) AS cnt FROM tags
WHERE date BETWEEN '2024-01-10' AND '2024-01-12' AND hour IN ('03', '17') GROUP BY date, hour, hashtag""")
def stream_archive_hours(spark, sf_dir):
    """Lookup of some hours in the log that the stream has written; other days are not read."""
    path = write_topic(spark, sf_dir)
    root, ckpt = scratch_path(spark, "s-archive"), scratch_path(spark, "ckpt")
    hs.run(hs.archive_merge(record_stream(spark, path), root, ckpt))
    hours = spark.createDataFrame([(f"2024-01-{d}", h) for d in (10, 11, 12) for h in ("03", "17")], "date string, hour string")
    return DeltaLog(spark, root).for_hours(hours)
