"""Structured Streaming forms of the hashtag jobs.

* stage 1 (arrival-time counts): status records -> per-micro-batch
  (date, hour, hashtag) deltas, encoded as ``date;hour`` / ``date;hour;hashtag;cnt``
  records for the next stage;
* arrival-time tumbling windows over short batches, and event-time tumbling windows, both in
  state behind a watermark;
* running totals: an hour's total is kept in state while it can change and written once when it is closed;
  current totals are the closed hours and the state together;
* stage 2: decode stats records and roll them up per micro-batch;
* archive merge: ``foreachBatch`` appends each batch's counts to a log-structured archive
  (``plans.delta_log``) under its batch id, so a replayed batch does not count twice.

Every query has its own checkpoint location in the shared folder and can be
stopped, or fail, and be restarted from it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larkspur.functions import codec, statuses, timefmt
from larkspur.operators import hashtags
from larkspur.sources.topic import RECORD_SCHEMA

REASONS = "status_reasons"
STATS_RECORD_SCHEMA = "key string, value string, batch_id bigint"


# ------------------------------------------------------------------ sources

# What one micro-batch reads unless told otherwise, from a topic or a folder: a batch's size does not
# grow with the backlog, whatever the sizes of files.
OFFSETS_PER_TRIGGER = 5_000_000
BYTES_PER_TRIGGER = 512 << 20


def _file_stream(spark: SparkSession, schema, path: str, max_files: int | None, max_bytes: int) -> DataFrame:
    limit = ("maxFilesPerTrigger", max_files) if max_files else ("maxBytesPerTrigger", max_bytes)
    return spark.readStream.schema(schema).option(*limit).parquet(path)


def record_stream(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int = BYTES_PER_TRIGGER) -> DataFrame:
    """Status records arriving as Parquet files under ``path``, oldest files first.

    A micro-batch takes ``max_files`` files if given, else files of ``max_bytes`` (one at least).
    """
    return _file_stream(spark, RECORD_SCHEMA, path, max_files, max_bytes)


def topic_options(servers: str, topic: str, max_offsets: int = OFFSETS_PER_TRIGGER) -> dict[str, str]:
    """Options of a rate-limited Kafka source from the earliest offset."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest",
            "maxOffsetsPerTrigger": str(max_offsets)}


def topic_stream(spark: SparkSession, servers: str, topic: str, max_offsets: int = OFFSETS_PER_TRIGGER) -> DataFrame:
    """Records of a Kafka topic from the earliest offset (needs the Kafka connector jar)."""
    raw = spark.readStream.format("kafka").options(**topic_options(servers, topic, max_offsets)).load()
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition",
                      "offset", F.col("timestamp").cast("long").alias("timestamp"), "timestampType")


def kafka_sink_options(servers: str, topic: str, checkpoint: str) -> dict[str, str]:
    """Options of a keyed Kafka sink (``key``/``value`` columns); failures fail the query."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint,
            "kafka.acks": "all"}


def kafka_stream_sink(records: DataFrame, servers: str, topic: str, checkpoint: str,
                      interval: str = "10 seconds") -> StreamingQuery:
    """Continuously publish ``key``/``value`` records to a Kafka topic (connector jar needed)."""
    return (records.select("key", "value").writeStream.format("kafka")
            .options(**kafka_sink_options(servers, topic, checkpoint))
            .trigger(processingTime=interval).start())


def kafka_batch_sink(records: DataFrame, servers: str, topic: str) -> None:
    """Publish a bounded frame of ``key``/``value`` records (e.g. inside ``foreachBatch``)."""
    (records.select("key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).option("kafka.acks", "all").save())


def stats_record_stream(spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int = BYTES_PER_TRIGGER) -> DataFrame:
    """Stats records that stage 1 has written, limited per micro-batch like ``record_stream``."""
    return _file_stream(spark, STATS_RECORD_SCHEMA, path, max_files, max_bytes)


# ----------------------------------------------------------------- running

def run(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for a bounded run (availableNow) or up to ``timeout_s``, then stop."""
    try:
        if timeout_s is None:
            query.awaitTermination()
        else:
            query.awaitTermination(timeout_s)
    finally:
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(f"stream {query.name} failed: {query.exception()}")
    return query


def _start(df_writer, bounded: bool, interval: str | None):
    if bounded:
        return df_writer.trigger(availableNow=True).start()
    return df_writer.trigger(processingTime=interval or "10 seconds").start()


# ------------------------------------------------------------------ stage 1

def created_tags(records: DataFrame) -> DataFrame:
    """(created, date, hour, hashtag) from status records; bad status/date -> no rows."""
    return hashtags.explode_hashtags_created(records, keep=())


def arrival_deltas(records: DataFrame, out_path: str, checkpoint: str, bounded: bool = True,
                   interval: str = "3 minutes") -> StreamingQuery:
    """Stage 1, arrival-time form: each trigger's hashtag counts, encoded as stats records.

    A processing-time trigger of the window length gives one tumbling
    window per trigger; no state is kept between triggers.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        enc = codec.encode(hashtags.hourly_counts(batch))
        # Dynamic overwrite of this batch's own folder: a replay replaces it.
        (enc.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))

    w = (created_tags(records).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint))
    return _start(w, bounded, interval)


def arrival_windows(records: DataFrame, out_path: str, checkpoint: str, length: str = "3 minutes", delay: str = "10 seconds",
                    bounded: bool = True, interval: str = "10 seconds") -> StreamingQuery:
    """Counts per tumbling window of arrival time and (date, hour, hashtag), over batches shorter than a window.

    A record's arrival is its topic timestamp, which is kept with it: a window holds the same records
    however they fall into micro-batches, also after a restart.  ``delay`` covers topic partitions that are
    behind others.  A closed window's rows are written once.
    """
    st = statuses.with_status(records)
    created = timefmt.parse_status_time(F.col("st_created_at"))
    timed = (st.select(F.timestamp_seconds("timestamp").alias("arrival"), F.date_format(created, "yyyy-MM-dd").alias("date"),
                       F.date_format(created, "HH").alias("hour"), F.col("st_entities.hashtags.text").alias("texts"))
             .withWatermark("arrival", delay))
    # explode_outer, so that records without hashtags move the watermark too (see ``timed_tags``).
    tags = (timed.select("arrival", "date", "hour", F.explode_outer("texts").alias("hashtag"))
            .where(F.col("hashtag").isNotNull() & F.col("date").isNotNull()))
    agg = (tags.groupBy(F.window("arrival", length).alias("w"), *hashtags.STATS_KEYS).agg(F.count(F.lit(1)).alias("cnt"))
           .select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), *hashtags.STATS_KEYS, "cnt"))
    w = (agg.writeStream.outputMode("append").format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint))
    return _start(w, bounded, interval)


def timed_tags(records: DataFrame, delay: str) -> DataFrame:
    """(created, hashtag) behind a watermark of ``delay`` on the status time.

    The watermark is set *before* hashtags are exploded, so statuses without hashtags still advance
    event time.  A status dated after its own record (beyond ``statuses.FUTURE_TOLERANCE``) is dropped
    first: it would close every open window.  What is dropped is counted per reason (``dropped_reasons``).
    """
    st = statuses.decoded(records).observe(REASONS, *statuses.reason_counts())
    timed = (st.where(F.col("st_created").isNotNull() & (F.col("st_reason") != statuses.FUTURE))
             .select(F.col("st_created").alias("created"), F.col("st_tags").alias("texts")).withWatermark("created", delay))
    # explode_outer: a plain explode lets the optimizer infer "has hashtags" and push that
    # filter below the watermark, so statuses without hashtags would not advance event time.
    return timed.select("created", F.explode_outer("texts").alias("hashtag")).where(F.col("hashtag").isNotNull())


def event_windows(records: DataFrame, out_path: str, checkpoint: str, length: str = "3 minutes",
                  delay: str = "10 minutes", bounded: bool = True) -> StreamingQuery:
    """Event-time tumbling windows of ``length`` per hashtag, append mode.

    ``delay`` must cover how far the topic is out of order between micro-batches; what comes later is
    dropped and counted in the query's ``numRowsDroppedByWatermark``.
    """
    agg = (timed_tags(records, delay).groupBy(F.window("created", length).alias("w"), "hashtag")
           .agg(F.count(F.lit(1)).alias("cnt"))
           .select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "hashtag", "cnt"))
    w = (agg.writeStream.outputMode("append").format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint))
    return _start(w, bounded, None)


def running_totals(records: DataFrame, out_path: str, checkpoint: str, delay: str = "2 hours", bounded: bool = True,
                   wrap: Callable[[Callable], Callable] = lambda write: write) -> StreamingQuery:
    """Cumulative (date, hour, hashtag) totals.

    Keys are hourly event-time windows.  While an hour can change, its totals are in the state store; once the
    watermark has passed it, they are written to ``out_path``, once, and leave the state.  ``latest_totals``
    reads both.  ``wrap`` decorates the function that writes a batch.
    """
    agg = (timed_tags(records, delay).groupBy(F.window("created", "1 hour").alias("w"), "hashtag")
           .agg(F.count(F.lit(1)).alias("cnt")))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # Dynamic overwrite of this batch's own folder: a replay replaces it.
        (_by_hour(batch, "w", "hashtag", "cnt").withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))

    w = (agg.writeStream.outputMode("append").foreachBatch(wrap(write_batch))
         .option("checkpointLocation", checkpoint))
    return _start(w, bounded, None)


def _by_hour(rows: DataFrame, window: str, hashtag: str, count: str) -> DataFrame:
    start = F.col(f"{window}.start")
    return rows.select(F.date_format(start, "yyyy-MM-dd").alias("date"), F.date_format(start, "HH").alias("hour"),
                       F.col(hashtag).alias("hashtag"), F.col(count).cast("bigint").alias("cnt"))


@contextmanager
def changelog_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB and checkpoint its changes only."""
    settings = {"spark.sql.streaming.stateStore.providerClass":
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
                "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def crash_in(batch_id: int, after: bool) -> Callable[[Callable], Callable]:
    """For tests of recovery: the batch fails before, or after, it has been written, as when the driver dies there."""
    def wrap(write: Callable) -> Callable:
        def failing(batch: DataFrame, number: int) -> None:
            if number == batch_id and not after:
                raise RuntimeError("injected crash")
            write(batch, number)
            if number == batch_id:
                raise RuntimeError("injected crash")
        return failing
    return wrap


def dropped_late(query: StreamingQuery) -> int:
    """Rows that a finished query dropped behind its watermark, over the progress it still holds."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def dropped_reasons(query: StreamingQuery) -> dict[str, int]:
    """Records read, and those that did not count per reason, over the progress that a finished query still holds."""
    out: dict[str, int] = {}
    for p in query.recentProgress:
        for k, n in p["observedMetrics"].get(REASONS, {}).items():
            out[k] = out.get(k, 0) + n
    return out


def open_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Totals of the hours that can still change, read from the state store of a running or stopped query."""
    from larkspur.plans.archive import _exists
    if not _exists(spark, f"{checkpoint}/state/0"):
        return spark.createDataFrame([], hashtags.STATS_SCHEMA)
    state = spark.read.format("statestore").load(checkpoint)
    hour, tag = (f.name for f in state.schema["key"].dataType.fields)
    (count,) = (f.name for f in state.schema["value"].dataType.fields)
    return _by_hour(state.select(F.col("key")[hour].alias("w"), F.col("key")[tag].alias("hashtag"),
                                 F.col("value")[count].alias("cnt")), "w", "hashtag", "cnt")


def closed_totals(spark: SparkSession, out_path: str) -> DataFrame:
    """Totals of the hours that the watermark has passed; each is there once."""
    from larkspur.plans.archive import _exists
    if not _exists(spark, out_path):
        return spark.createDataFrame([], hashtags.STATS_SCHEMA)
    return spark.read.schema(hashtags.STATS_SCHEMA).parquet(out_path).select(*hashtags.STATS_KEYS, "cnt")


def latest_totals(spark: SparkSession, out_path: str, checkpoint: str) -> DataFrame:
    """Current total per key: one row read per key, however many batches there were."""
    return closed_totals(spark, out_path).unionByName(open_totals(spark, checkpoint))


# ------------------------------------------------------------------ stage 2

def rollup_stage(stats_records: DataFrame, out_path: str, checkpoint: str, bounded: bool = True,
                 interval: str = "10 minutes") -> StreamingQuery:
    """Stage 2: decode stats records and sum them per trigger (deltas, no state)."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (codec.rollup(codec.decode(batch)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))

    w = stats_records.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _start(w, bounded, interval)


def sum_of_deltas(spark: SparkSession, path: str) -> DataFrame:
    """stat_key -> total over every emitted batch delta."""
    return (spark.read.parquet(path).groupBy("stat_key")
            .agg(F.sum("cnt").cast("bigint").alias("cnt")))


def decoded_totals(spark: SparkSession, records_path: str) -> DataFrame:
    """(date, hour, hashtag) totals from stats records stored by stage 1."""
    recs = spark.read.parquet(records_path)
    return (codec.decode_columns(recs).groupBy(*hashtags.STATS_KEYS)
            .agg(F.sum("cnt").cast("bigint").alias("cnt")))


# --------------------------------------------------------- archive merge

def archive_merge(records: DataFrame, log_root: str, checkpoint: str, bounded: bool = True,
                  interval: str = "2 seconds") -> StreamingQuery:
    """Append each batch's hourly counts to the log-structured archive at ``log_root``.

    A batch writes its own counts; runs are folded by size.  The append carries the micro-batch's id: a batch that is
    replayed after a failure is skipped or written anew, never counted twice.
    """
    from larkspur.plans.delta_log import DeltaLog

    def merge(batch: DataFrame, batch_id: int) -> None:
        DeltaLog(batch.sparkSession, log_root).append(hashtags.batch_hourly_counts(batch), checkpoint, batch_id)

    w = records.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return _start(w, bounded, interval)
