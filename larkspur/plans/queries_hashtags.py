"""Family A: hashtag batch jobs over topic records derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import codec
from larkspur.operators import hashtags
from larkspur.plans import archive, delta_log
from larkspur.plans.sqlfix import STATUS_TAGS
from larkspur.registry import register
from larkspur.session import scratch_path
from larkspur.sources import topic
from larkspur.sources.tables import table

# Fixed parameters of the registered queries.
TRACKED_KEYWORDS = ("big", "data", "ai", "machine", "learning", "course")
SLICE_START = '{"statuses": {"0": 100, "1": 150, "2": 200}}'
SLICE_BATCH = 3000
BOUNDED_START = '{"statuses": {"0": 100, "1": 150, "2": -2}}'
BATCH_PARTITION = 2            # batch = topic partition 2 from BATCH_SINCE on;
BATCH_SINCE = "2024-01-21"     # the archive holds every other record


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic.status_records(table(spark, sf_dir, "events"))


def _archive_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rec = records(spark, sf_dir)
    since = F.unix_seconds(F.to_timestamp(F.lit(BATCH_SINCE)))
    in_batch = (F.col("partition") == BATCH_PARTITION) & (F.col("timestamp") >= since)
    arch, batch = rec.where(~in_batch), rec.where(in_batch)
    return hashtags.batch_hourly_counts(arch), hashtags.batch_hourly_counts(batch)


_ARCH_BATCH_SQL = f"""WITH {STATUS_TAGS},
arch AS (SELECT date, hour, hashtag, count(*) AS cnt FROM tags
         WHERE NOT ("partition" = 2 AND ts >= TIMESTAMP '2024-01-21') GROUP BY ALL),
batch AS (SELECT date, hour, hashtag, count(*) AS cnt FROM tags
          WHERE "partition" = 2 AND ts >= TIMESTAMP '2024-01-21' GROUP BY ALL),
hrs AS (SELECT DISTINCT date, hour FROM batch)
"""


@register("hashtag_explode", f"""WITH {STATUS_TAGS}
SELECT "partition", "offset", date, hour, hashtag FROM tags""")
def hashtag_explode(spark, sf_dir):
    return hashtags.explode_hashtags(records(spark, sf_dir))


@register("hashtag_explode_created", f"""WITH {STATUS_TAGS}
SELECT "partition", "offset", date, hour, hashtag FROM tags""")
def hashtag_explode_created(spark, sf_dir):
    return hashtags.explode_hashtags_created(records(spark, sf_dir))


@register("hashtag_hourly_counts", f"""WITH {STATUS_TAGS}
SELECT date, hour, hashtag, count(*) AS cnt FROM tags GROUP BY date, hour, hashtag""")
def hashtag_hourly_counts(spark, sf_dir):
    return hashtags.batch_hourly_counts(records(spark, sf_dir))


@register("hashtag_active_hours", f"""WITH {STATUS_TAGS}
SELECT DISTINCT date, hour FROM tags""")
def hashtag_active_hours(spark, sf_dir):
    return hashtags.active_hours(hashtags.batch_hourly_counts(records(spark, sf_dir)))


@register("us_status_filter", """SELECT 'user' || CAST(user_id AS VARCHAR) AS key,
  CAST(event_id % 3 AS INTEGER) AS "partition", CAST(event_id // 3 AS BIGINT) AS "offset"
FROM events WHERE user_id % 3 = 0 AND event_id % 50 <> 7""")
def us_status_filter(spark, sf_dir):
    return hashtags.us_statuses(records(spark, sf_dir)).select("key", "partition", "offset")


def _tag_sql(text):
    return (f"""CASE WHEN {text} IS NULL THEN '{{"indices":[0,null]}}' ELSE '{{"text":"' || {text} || """
            f"""'","indices":[0,' || CAST(length({text}) + 1 AS VARCHAR) || ']}}' END""")


# The status JSON of the fixture for a US status, field by field.
_US_VALUE_SQL = f"""'{{"created_at":"' || strftime(ts, '%a %b %d %H:%M:%S +0000 %Y')
  || '","text":"status ' || CAST(event_id AS VARCHAR) || '","user":{{"name":"user' || CAST(user_id AS VARCHAR)
  || '"}},"place":{{"country_code":"US"}}'
  || CASE WHEN event_id % 50 = 17 THEN '' WHEN event_type = 'error' THEN ',"entities":{{"hashtags":[]}}'
     WHEN event_id % 50 = 13 THEN ',"entities":{{}}'
     WHEN event_id % 50 = 21 THEN ',"entities":{{"hashtags":[{{"indices":[0,null]}},' || {_tag_sql("event_type")} || ']}}'
     ELSE ',"entities":{{"hashtags":[' || {_tag_sql("event_type")} || ',' || {_tag_sql("k_tag")}
       || CASE WHEN event_type = 'purchase' THEN ',' || {_tag_sql("event_type")} ELSE '' END
       || CASE WHEN event_id % 50 = 41 THEN ',' || {_tag_sql("semi_tag")} ELSE '' END || ']}}' END
  || CASE WHEN event_id % 50 = 33
     THEN ',"retweeted_status":{{"entities":{{"hashtags":[' || {_tag_sql("'rt' || event_type")} || ']}}}}' ELSE '' END || '}}'"""


@register("topic_record_projection", f"""SELECT 'statuses_us' AS topic, 'user' || CAST(user_id AS VARCHAR) AS key,
  CAST(epoch(date_trunc('second', ts)) AS BIGINT) * 1000 AS timestamp_ms, {_US_VALUE_SQL} AS value,
  CAST(event_id % 3 AS INTEGER) AS "partition", CAST(event_id // 3 AS BIGINT) AS "offset"
FROM (SELECT *, 'k' || json_extract_string(props, '$.k') AS k_tag,
             'k;' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 AS VARCHAR) AS semi_tag FROM events)
WHERE user_id % 3 = 0 AND event_id % 50 <> 7""")
def topic_record_projection(spark, sf_dir):
    """Ingest records of US statuses, written to a topic folder and read back unchanged."""
    path = scratch_path(spark, "ingest-topic")
    ingested = hashtags.ingest_records(records(spark, sf_dir), country="US")
    ingested.write.parquet(path)
    return spark.read.schema(ingested.schema).parquet(path)


TRACKED_STATUS_WORDS = ("100", "250", "999", "status-1")


@register("status_track_filter", """SELECT 'user' || CAST(user_id AS VARCHAR) AS key,
  CAST(event_id % 3 AS INTEGER) AS "partition", CAST(event_id // 3 AS BIGINT) AS "offset"
FROM events WHERE event_id IN (100, 250, 999) AND event_id % 50 <> 7""")
def status_track_filter(spark, sf_dir):
    return hashtags.tracked_statuses(records(spark, sf_dir), TRACKED_STATUS_WORDS).select("key", "partition", "offset")


@register("topic_bounded_read", """SELECT 'user' || CAST(user_id AS VARCHAR) AS key,
  CAST(event_id % 3 AS INTEGER) AS "partition", CAST(event_id // 3 AS BIGINT) AS "offset"
FROM events WHERE event_id // 3 >= CASE event_id % 3 WHEN 0 THEN 100 WHEN 1 THEN 150 ELSE 0 END
  AND event_id // 3 < 1000 + CASE event_id % 3 WHEN 0 THEN 100 WHEN 1 THEN 150 ELSE 0 END""")
def topic_bounded_read(spark, sf_dir):
    """One bounded batch [start, end) per partition; partition 2 starts at its earliest offset."""
    rec = records(spark, sf_dir)
    start = topic.resolve_offsets(rec, BOUNDED_START)
    ranges = topic.offset_ranges(spark, start, topic.end_offsets(start, SLICE_BATCH))
    return topic.slice_records(rec, ranges).select("key", "partition", "offset")


@register("hashtag_quality", """SELECT CAST(count(*) AS BIGINT) AS records,
  CAST(count(*) FILTER (event_id % 50 = 7) AS BIGINT) AS unparseable,
  CAST(count(*) FILTER (event_id % 50 <> 7 AND (event_type = 'error' OR event_id % 50 IN (13, 17))) AS BIGINT) AS without_hashtags
FROM events""")
def hashtag_quality(spark, sf_dir):
    """Counters of the records that the batch job drops, gathered while it appends its counts to the log, from one parse."""
    decoded, metrics = hashtags.with_quality_metrics(records(spark, sf_dir), "hashtag_batch")
    delta_log.DeltaLog(spark, scratch_path(spark, "hashtag-log")).append(hashtags.decoded_hourly_counts(decoded), "batch", 0)
    return spark.createDataFrame([metrics.get], "records long, unparseable long, without_hashtags long")


@register("status_reasons", """SELECT CASE WHEN event_id % 50 = 7 THEN 'malformed' WHEN "offset" % 89 = 3 THEN 'undated'
  WHEN "offset" % 97 = 5 THEN 'future' WHEN event_type = 'error' OR event_id % 50 IN (13, 17) THEN 'untagged' ELSE 'counted' END AS reason,
  count(*) AS n
FROM (SELECT *, event_id // 3 AS "offset" FROM events) GROUP BY 1""")
def status_reasons(spark, sf_dir):
    """Why records do not count, over a topic with some blanked dates and some records stamped two hours before their status."""
    rec = records(spark, sf_dir)
    undated, early = F.col("offset") % 89 == 3, F.col("offset") % 97 == 5
    blanked = F.regexp_replace("value", '"created_at":"[^"]*"', '"created_at":"some day"')
    return hashtags.reasons(rec.withColumns({"value": F.when(undated, blanked).otherwise(F.col("value")),
                                             "timestamp": F.when(early, F.col("timestamp") - 7200).otherwise(F.col("timestamp"))}))


@register("keyword_track_filter", """SELECT doc_id, count(*) AS n_hits FROM (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\\W+')) AS t FROM documents)
WHERE t IN ('big', 'data', 'ai', 'machine', 'learning', 'course')
GROUP BY doc_id""")
def keyword_track_filter(spark, sf_dir):
    return hashtags.keyword_hits(table(spark, sf_dir, "documents"), TRACKED_KEYWORDS)


@register("topic_offset_slice", """SELECT "partition", "offset", key,
  CAST(("offset" - CASE "partition" WHEN 0 THEN 100 WHEN 1 THEN 150 ELSE 200 END) // 1000 AS BIGINT) AS slice
FROM (
  SELECT CAST(event_id % 3 AS INTEGER) AS "partition", CAST(event_id // 3 AS BIGINT) AS "offset",
         'user' || CAST(user_id AS VARCHAR) AS key FROM events)
WHERE "offset" >= CASE "partition" WHEN 0 THEN 100 WHEN 1 THEN 150 ELSE 200 END""")
def topic_offset_slice(spark, sf_dir):
    """The whole topic consumed in consecutive offset slices of SLICE_BATCH records."""
    _, start = topic.parse_offsets(SLICE_START)
    per_partition = SLICE_BATCH // len(start)
    end = topic.end_offsets(SLICE_START, SLICE_BATCH)
    ranges = topic.offset_ranges(spark, SLICE_START, end)
    return topic.assign_slices(records(spark, sf_dir), ranges, per_partition) \
        .select("partition", "offset", "key", "slice")


@register("archive_partition_lookup", _ARCH_BATCH_SQL + """
SELECT a.date, a.hour, a.hashtag, CAST(a.cnt AS BIGINT) AS cnt FROM arch a SEMI JOIN hrs USING (date, hour)""")
def archive_partition_lookup(spark, sf_dir):
    arch, batch = _archive_and_batch(spark, sf_dir)
    root = scratch_path(spark, "hashtag-archive")
    archive.write_partitions(arch, root, fresh=True)
    looked_up, _ = archive.archived_for(spark, batch, root)
    return looked_up


@register("hashtag_archive_merge", _ARCH_BATCH_SQL + """
SELECT date, hour, hashtag, CAST(sum(cnt) AS BIGINT) AS cnt FROM (
  SELECT * FROM arch SEMI JOIN hrs USING (date, hour) UNION ALL SELECT * FROM batch)
GROUP BY date, hour, hashtag""")
def hashtag_archive_merge(spark, sf_dir):
    arch, batch = _archive_and_batch(spark, sf_dir)
    root = scratch_path(spark, "hashtag-archive")
    archive.write_partitions(arch, root, fresh=True)
    counted = scratch_path(spark, "batch-counts")           # the batch is counted once, for its hours and for the sum
    batch.write.parquet(counted)
    batch = spark.read.schema(hashtags.STATS_SCHEMA).parquet(counted)
    looked_up, _ = archive.archived_for(spark, batch, root)
    return hashtags.merge_counts(batch, looked_up)


@register("hashtag_partition_upsert", _ARCH_BATCH_SQL + """
SELECT date, hour, hashtag, CAST(sum(cnt) AS BIGINT) AS cnt FROM (
  SELECT * FROM arch UNION ALL SELECT * FROM batch)
GROUP BY date, hour, hashtag""")
def hashtag_partition_upsert(spark, sf_dir):
    arch, batch = _archive_and_batch(spark, sf_dir)
    root = scratch_path(spark, "hashtag-archive")
    archive.write_partitions(arch, root, fresh=True)
    for _ in range(2):                         # the second run of the same batch changes nothing
        archive.upsert(spark, batch, root, batch_id="batch-1")
    return archive.read_archive(spark, root)


@register("stats_csv_scan", f"""WITH {STATUS_TAGS}
SELECT date, hour, hashtag, count(*) AS cnt FROM tags GROUP BY date, hour, hashtag""")
def stats_csv_scan(spark, sf_dir):
    from larkspur.sources import delimited
    path = scratch_path(spark, "stats-csv")
    delimited.write_stats_csv(hashtags.batch_hourly_counts(records(spark, sf_dir)), path)
    return delimited.read_stats_csv(spark, path)


@register("stats_record_format", f"""WITH {STATUS_TAGS},
c AS (SELECT date, hour, hashtag, count(*) AS cnt FROM tags GROUP BY date, hour, hashtag)
SELECT date || ';' || hour AS key, date || ';' || hour || ';' || hashtag || ';' || CAST(cnt AS VARCHAR) AS value FROM c""")
def stats_record_format(spark, sf_dir):
    return codec.encode(hashtags.batch_hourly_counts(records(spark, sf_dir)))


@register("stats_record_parse", f"""WITH {STATUS_TAGS}
SELECT date || ';' || hour || ';' || hashtag AS stat_key, count(*) AS cnt FROM tags GROUP BY date, hour, hashtag""")
def stats_record_parse(spark, sf_dir):
    encoded = codec.encode(hashtags.batch_hourly_counts(records(spark, sf_dir)))
    return codec.rollup(codec.decode(encoded))
