"""Topic records: the message-topic data model and its bounded slices.

A topic record has the columns of the Kafka source
(key, value, topic, partition, offset, timestamp, timestampType).  The Kafka
connector jar is optional: ``read_topic_batch`` builds the real reader, and
every operator takes any DataFrame of record shape, so file- or
table-backed records work the same way.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions import timefmt

RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.LongType()),      # epoch seconds
    T.StructField("timestampType", T.IntegerType()),
])

STATUS_TOPIC = "statuses"
TOPIC_PARTITIONS = 3
# Offsets in the Kafka JSON form: -2 = earliest, -1 = latest.
EARLIEST, LATEST = -2, -1


def status_records(events: DataFrame, topic: str = STATUS_TOPIC,
                   partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """Status messages derived from the ``events`` table (fixture rule).

    * user name ``user<user_id>`` is the record key;
    * ``created_at`` / record timestamp from ``ts``;
    * hashtags: ``event_type`` and ``k<props.k>``; a purchase repeats its
      event type; ``error`` events carry an empty list;
    * ``event_id % 50``: 7 = malformed JSON, 13 = no ``entities.hashtags``,
      17 = no ``entities``, 21 = a tag without text before the event type,
      33 = a nested ``retweeted_status`` with its own (ignored) hashtag,
      41 = an extra tag ``k;<k % 7>`` containing the stats delimiter;
    * place: ``user_id % 3`` 0 = US, 1 = GB (odd users: no country code),
      2 = no place;
    * round-robin partitioning: partition = event_id % partitions,
      offset = event_id div partitions (dense per partition).
    """
    e = events.select(
        "event_id", "ts", "user_id", "event_type",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))
    m = F.col("event_id") % 50
    et = F.col("event_type")

    def tag(text: F.Column) -> F.Column:
        return F.struct(text.alias("text"),
                        F.array(F.lit(0).cast("bigint"), (F.length(text) + 1).cast("bigint")).alias("indices"))

    k_tag = F.concat(F.lit("k"), F.col("k").cast("string"))
    semi_tag = F.concat(F.lit("k;"), (F.col("k") % 7).cast("string"))
    base = F.when(et == "purchase", F.array(tag(et), tag(k_tag), tag(et))).otherwise(F.array(tag(et), tag(k_tag)))
    tags = (F.when(et == "error", F.array().cast(T.ArrayType(_tag_type())))
            .when(m == 13, F.lit(None).cast(T.ArrayType(_tag_type())))
            .when(m == 21, F.array(tag(F.lit(None).cast("string")), tag(et)))
            .when(m == 41, F.concat(base, F.array(tag(semi_tag))))
            .otherwise(base))
    entities = F.when(m == 17, F.lit(None)).otherwise(F.struct(tags.alias("hashtags")))
    # A quoted (nested) status carries hashtags of its own, which must not be counted.
    nested = F.when(m == 33, F.struct(F.struct(F.array(tag(F.concat(F.lit("rt"), et))).alias("hashtags"))
                                      .alias("entities")))
    place = (F.when(F.col("user_id") % 3 == 0, F.struct(F.lit("US").alias("country_code")))
             .when((F.col("user_id") % 3 == 1) & (F.col("user_id") % 2 == 0),
                   F.struct(F.lit("GB").alias("country_code")))
             .when(F.col("user_id") % 3 == 1, F.struct(F.lit(None).cast("string").alias("country_code"))))
    name = F.concat(F.lit("user"), F.col("user_id").cast("string"))
    status = F.struct(
        timefmt.format_status_time(F.col("ts")).alias("created_at"),
        F.concat(F.lit("status "), F.col("event_id").cast("string")).alias("text"),
        F.struct(name.alias("name")).alias("user"),
        place.alias("place"),
        entities.alias("entities"),
        nested.alias("retweeted_status"),
    )
    value = F.when(m == 7, F.concat(F.lit('{"created_at": "broken'), F.col("event_id").cast("string"))) \
        .otherwise(F.to_json(status))
    return e.select(
        name.alias("key"),
        value.alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("event_id") % partitions).cast("int").alias("partition"),
        F.floor(F.col("event_id") / partitions).cast("bigint").alias("offset"),
        timefmt.epoch_seconds(F.col("ts")).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def _tag_type() -> T.StructType:
    return T.StructType([T.StructField("text", T.StringType()),
                         T.StructField("indices", T.ArrayType(T.LongType()))])


# ---------------------------------------------------------------- offsets

def parse_offsets(offsets_json: str | None) -> tuple[str, dict[int, int]]:
    """Kafka offset JSON ``{"topic": {"0": 50, "1": -1}}`` -> (topic, {partition: offset}).

    Exactly one topic is accepted; null, empty, malformed and multi-topic
    input raise ``ValueError``.
    """
    if offsets_json is None:
        raise ValueError("pass the offsets of one topic as JSON; got None")
    if not offsets_json.strip():
        raise ValueError("pass the offsets of one topic as JSON; got blank text")
    try:
        parsed = json.loads(offsets_json)
    except json.JSONDecodeError as exc:
        raise ValueError(f"offsets are not JSON: {offsets_json!r}") from exc
    if not isinstance(parsed, dict) or len(parsed) != 1:
        raise ValueError(f"give offsets for exactly one topic: {offsets_json!r}")
    topic, parts = next(iter(parsed.items()))
    if not isinstance(parts, dict) or not parts:
        raise ValueError(f"topic {topic!r} needs a partition -> offset object")
    try:
        return topic, {int(p): int(o) for p, o in parts.items()}
    except (TypeError, ValueError) as exc:
        raise ValueError(f"partitions and offsets of {topic!r} must be whole numbers") from exc


def offsets_to_json(topic: str, offsets: dict[int, int]) -> str:
    return json.dumps({topic: {str(p): o for p, o in sorted(offsets.items())}})


def _resolved(offsets_json: str | None) -> tuple[str, dict[int, int]]:
    topic, offsets = parse_offsets(offsets_json)
    special = sorted(p for p, o in offsets.items() if o < 0)
    if special:
        raise ValueError(f"partitions {special} of {topic!r} have special offsets: call resolve_offsets first")
    return topic, offsets


def resolve_offsets(records: DataFrame, offsets_json: str) -> str:
    """Offsets with earliest / latest replaced by the topic's first offset / one past its last.

    Reads one row per topic partition; a partition without records starts and ends at 0.
    """
    topic, offsets = parse_offsets(offsets_json)
    known = {r["partition"]: r for r in records.where(F.col("topic") == topic).groupBy("partition")
             .agg(F.min("offset").alias("first"), F.max("offset").alias("last")).collect()}

    def number(p: int, o: int) -> int:
        if o not in (EARLIEST, LATEST):
            return o
        if p not in known:
            return 0
        return known[p]["first"] if o == EARLIEST else known[p]["last"] + 1
    return offsets_to_json(topic, {p: number(p, o) for p, o in offsets.items()})


def end_offsets(start_json: str, batch_size: int) -> str:
    """End offsets of a batch: start + batch_size / #partitions on every partition.

    The batch size must divide evenly over the partitions.  Special start offsets (earliest, latest) have
    no end yet: ``resolve_offsets`` turns them into numbers first.
    """
    topic, start = _resolved(start_json)
    if batch_size <= 0 or batch_size % len(start):
        raise ValueError("batch size must be a positive multiple of the partition count")
    per_part = batch_size // len(start)
    return offsets_to_json(topic, {p: o + per_part for p, o in start.items()})


def offset_ranges(spark: SparkSession, start_json: str, end_json: str) -> DataFrame:
    """One row per topic partition: (topic, partition, start, end).

    Its size is the partition count of one topic, known on the driver,
    so it may be broadcast.
    """
    topic, start = _resolved(start_json)
    topic_end, end = _resolved(end_json)
    if topic_end != topic or set(end) != set(start):
        raise ValueError("start and end offsets must name the same topic and partitions")
    rows = [(topic, p, s, end[p]) for p, s in sorted(start.items())]
    return spark.createDataFrame(rows, "topic string, partition int, start_offset bigint, end_offset bigint")


def slice_records(records: DataFrame, ranges: DataFrame) -> DataFrame:
    """Bounded read of ``[start, end)`` on each partition (range join).

    ``ranges`` is one row per topic partition, so the broadcast is bounded
    by the partition count; the record side is never shuffled.
    """
    r = F.broadcast(ranges.alias("r"))
    cond = ((F.col("rec.topic") == F.col("r.topic")) & (F.col("rec.partition") == F.col("r.partition"))
            & (F.col("rec.offset") >= F.col("r.start_offset"))
            & (F.col("rec.offset") < F.col("r.end_offset")))
    return records.alias("rec").join(r, cond, "left_semi")


def assign_slices(records: DataFrame, ranges: DataFrame, per_partition: int) -> DataFrame:
    """Every record from its partition's start offset on, with the number of the
    consecutive slice (batch) that reads it: ``(offset - start) div per_partition``.

    The whole topic is consumed in fixed-size slices, as the polling batch job
    does; ``ranges`` is one row per partition (broadcast, bounded by the
    partition count).
    """
    r = F.broadcast(ranges.select("topic", "partition", "start_offset").alias("r"))
    cond = ((F.col("rec.topic") == F.col("r.topic")) & (F.col("rec.partition") == F.col("r.partition"))
            & (F.col("rec.offset") >= F.col("r.start_offset")))
    return (records.alias("rec").join(r, cond, "inner")
            .select("rec.*", F.floor((F.col("rec.offset") - F.col("r.start_offset")) / F.lit(per_partition))
                    .cast("bigint").alias("slice")))


def read_topic_batch(spark: SparkSession, servers: str, topic: str,
                     start_json: str, end_json: str) -> DataFrame:
    """Bounded batch read from a Kafka topic (needs the Kafka connector jar)."""
    raw = (spark.read.format("kafka")
           .option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic)
           .option("startingOffsets", start_json)
           .option("endingOffsets", end_json)
           .load())
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition",
                      "offset", F.col("timestamp").cast("long").alias("timestamp"), "timestampType")
