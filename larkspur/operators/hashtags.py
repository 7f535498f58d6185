"""Hashtag counting: explode, hourly counts, merge into an archive.

Every count is a hash aggregate with map-side partial aggregation, so a
hashtag that dominates an hour is combined inside each task before the
shuffle and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions import statuses, timefmt

STATS_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("hour", T.StringType()),
    T.StructField("hashtag", T.StringType()),
    T.StructField("cnt", T.LongType()),
])
STATS_KEYS = ["date", "hour", "hashtag"]


def explode_hashtags(records: DataFrame, keep: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """One row per hashtag occurrence, dated by the record timestamp.

    Malformed JSON, a missing ``entities.hashtags`` and ``[]`` give no rows;
    a hashtag without text is dropped.
    """
    ts = F.col("timestamp").cast("long")
    tag = F.explode(statuses.hashtag_texts(statuses.parse_status(F.col("value").cast("string"))))
    return (records
            .select(*keep, timefmt.epoch_date(ts).alias("date"), timefmt.epoch_hour(ts).alias("hour"),
                    tag.alias("hashtag"))
            .where(F.col("hashtag").isNotNull()))


def explode_hashtags_created(records: DataFrame, keep: tuple[str, ...] = ("partition", "offset"),
                             hour_format: str = "HH") -> DataFrame:
    """Same, dated by the status' own ``created_at`` (stream form).

    A null status, absent hashtags or an unparseable date give no rows.
    ``hour_format="H"`` reproduces an unpadded hour.
    """
    st = statuses.parse_status(F.col("value").cast("string"))
    return (records
            .select(*keep, st.alias("st"))
            .select(*keep, timefmt.parse_status_time(F.col("st.created_at")).alias("created"),
                    F.explode(statuses.hashtag_texts(F.col("st"))).alias("hashtag"))
            .where(F.col("created").isNotNull() & F.col("hashtag").isNotNull())
            .select(*keep, F.date_format("created", "yyyy-MM-dd").alias("date"),
                    F.date_format("created", hour_format).alias("hour"), "hashtag"))


def with_quality_metrics(records: DataFrame, name: str = "status_quality"):
    """Decode statuses and attach ``observe()`` metrics: records, unparseable statuses, statuses without hashtags.

    Returns (decoded frame, Observation); the metrics are filled by the first action
    on the returned frame, at no extra pass over the data and from the same parse that
    ``decoded_hourly_counts`` counts.
    """
    from pyspark.sql import Observation
    obs = Observation(name)
    st = statuses.decoded(records)
    unparseable = F.col("st_reason") == statuses.MALFORMED
    n_tags = F.coalesce(F.size("st_tags"), F.lit(-1))
    return st.observe(
        obs,
        F.count(F.lit(1)).alias("records"),
        F.count(F.when(unparseable, 1)).alias("unparseable"),
        F.count(F.when(~unparseable & (n_tags <= 0), 1)).alias("without_hashtags")), obs


def decoded_hourly_counts(decoded: DataFrame) -> DataFrame:
    """(date, hour, hashtag) -> cnt of decoded statuses, dated by the record timestamp; no second parse."""
    ts = F.col("timestamp").cast("long")
    tags = (decoded.select(timefmt.epoch_date(ts).alias("date"), timefmt.epoch_hour(ts).alias("hour"), F.explode("st_tags").alias("hashtag"))
            .where(F.col("hashtag").isNotNull()))
    return hourly_counts(tags)


def reasons(records: DataFrame) -> DataFrame:
    """(reason, n): how many records count, and how many do not for each reason."""
    return statuses.decoded(records).groupBy(F.col("st_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def hourly_counts(tags: DataFrame) -> DataFrame:
    """(date, hour, hashtag) -> cnt over exploded hashtag rows."""
    return tags.groupBy(*STATS_KEYS).agg(F.count(F.lit(1)).alias("cnt")).select(*STATS_KEYS, "cnt")


def batch_hourly_counts(records: DataFrame) -> DataFrame:
    """Topic records -> hourly hashtag counts (the batch job's aggregation)."""
    return hourly_counts(explode_hashtags(records, keep=()))


def active_hours(stats: DataFrame) -> DataFrame:
    """Distinct (date, hour) touched by a batch."""
    return stats.select("date", "hour").distinct()


def touched(archive: DataFrame, hours: DataFrame, dates: tuple[str, str]) -> DataFrame:
    """Archive rows whose (date, hour) partition is in ``hours``.

    A left-semi join on the partition columns with the hours' date bounds on both sides:
    static partition pruning by date, dynamic pruning by hour.
    """
    within = F.col("date").between(*dates)
    return archive.where(within).join(hours.where(within), ["date", "hour"], "left_semi")


def merge_counts(batch: DataFrame, archived: DataFrame) -> DataFrame:
    """UNION ALL of archive and batch counts, then sum per key."""
    return (archived.select(*STATS_KEYS, "cnt").unionByName(batch.select(*STATS_KEYS, "cnt"))
            .groupBy(*STATS_KEYS).agg(F.sum("cnt").cast("bigint").alias("cnt")))


def us_statuses(records: DataFrame, country: str = "US") -> DataFrame:
    """Statuses whose place has the given country code; no place / no code drops."""
    return (statuses.with_status(records).where(F.col("st_place.country_code") == F.lit(country))
            .select(*records.columns))


def tracked_statuses(records: DataFrame, keywords: tuple[str, ...]) -> DataFrame:
    """Status records whose text mentions a tracked keyword (whole tokens, any case)."""
    return (statuses.with_status(records)
            .where(F.coalesce(F.lower("st_text").rlike(keyword_pattern(keywords)), F.lit(False)))
            .select(*records.columns))


def keyword_pattern(keywords: tuple[str, ...]) -> str:
    """Regex matching any keyword as a whole token (no word character on either side)."""
    import re
    alts = "|".join(re.escape(k.lower()) for k in keywords)
    return rf"(?<![A-Za-z0-9_])(?:{alts})(?![A-Za-z0-9_])"


def ingest_records(records: DataFrame, topic: str = "statuses_us", country: str | None = None) -> DataFrame:
    """Ingest projection: key = user name, timestamp = created_at (ms), value unchanged.

    With ``country`` only statuses from there; filter and projection share one parse.
    """
    parsed = statuses.with_status(records)
    if country is not None:
        parsed = parsed.where(F.col("st_place.country_code") == F.lit(country))
    created = timefmt.parse_status_time(F.col("st_created_at"))
    return (parsed
            .select(F.lit(topic).alias("topic"), F.col("st_user.name").alias("key"),
                    (F.unix_seconds(created) * 1000).alias("timestamp_ms"), "value",
                    "partition", "offset")
            .where(F.col("timestamp_ms").isNotNull()))


def keyword_hits(docs: DataFrame, keywords: tuple[str, ...], text_col: str = "text",
                 id_col: str = "doc_id") -> DataFrame:
    """Documents mentioning any tracked keyword, with the number of hits.

    Lower-cased text is split on non-word characters; every token equal to a
    keyword counts.  Runs over the whole text inside one projection.
    """
    # A token (maximal run of word characters) equals a keyword exactly when the keyword
    # occurs with no word character on either side: one regex scan, no token array.
    hits = F.regexp_count(F.lower(F.col(text_col)), F.lit(keyword_pattern(keywords)))
    return (docs.select(F.col(id_col), hits.cast("bigint").alias("n_hits"))
            .where(F.col("n_hits") > 0))
