"""Status (tweet) JSON: the narrow read schema and hashtag extraction.

Only the top-level ``entities.hashtags`` are read; hashtags of nested
retweeted/extended statuses are ignored.  ``from_json`` with a narrow schema
lets the JSON parser skip every other field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASHTAG = T.StructType([T.StructField("text", T.StringType())])
HASHTAGS = T.ArrayType(HASHTAG)

STATUS = T.StructType([
    T.StructField("created_at", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("user", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("place", T.StructType([T.StructField("country_code", T.StringType())])),
    T.StructField("entities", T.StructType([T.StructField("hashtags", HASHTAGS)])),
])


def parse_status(value: Column) -> Column:
    """JSON text -> status struct; malformed text -> NULL (never raises)."""
    return F.from_json(value, STATUS, {"mode": "PERMISSIVE"})


def hashtag_texts(status: Column) -> Column:
    """array<string> of hashtag texts; NULL when absent (explode drops it)."""
    return status["entities"]["hashtags"]["text"]


def with_status(records: DataFrame) -> DataFrame:
    """``records`` with st_created_at, st_text, st_user, st_place and st_entities of their status.

    The one-element ``inline`` keeps the parse in one place: a filter on the new columns is not
    pushed below it, where it would parse the text again.
    """
    names = [f"st_{f.name}" for f in STATUS.fields]
    return records.select("*", F.inline(F.array(parse_status(F.col("value").cast("string")))).alias(*names))


# Why a status does not count, in order of precedence.
MALFORMED, UNDATED, FUTURE, UNTAGGED, COUNTED = "malformed", "undated", "future", "untagged", "counted"
# A status dated later than its record by more than this moves event time too far.
FUTURE_TOLERANCE = "1 hour"


def decoded(records: DataFrame) -> DataFrame:
    """``records`` with ``st_created`` (timestamp), ``st_tags`` (texts of the top-level hashtags) and ``st_reason``.

    The text is parsed once, into a VARIANT value that every field is read from; text that is not JSON, or JSON
    without any field of a status, is ``malformed``.  As in ``with_status`` the parse stands in an ``inline``,
    below which nothing is pushed; so do the fields, which are then read once too.
    """
    from larkspur.functions import timefmt
    parsed = records.select("*", F.inline(F.array(F.struct(F.try_parse_json(F.col("value").cast("string")).alias("st_json")))))
    j = F.col("st_json")
    known = F.lit(False)
    for f in STATUS.fields:
        known = known | F.try_variant_get(j, f"$.{f.name}", "variant").isNotNull()
    tags = F.transform(F.try_variant_get(j, "$.entities.hashtags", "array<variant>"), lambda t: F.try_variant_get(t, "$.text", "string"))
    fields = F.struct(timefmt.parse_status_time(F.try_variant_get(j, "$.created_at", "string")).alias("st_created"),
                      tags.alias("st_tags"), F.coalesce(known, F.lit(False)).alias("st_known"))
    out = parsed.select(*records.columns, F.inline(F.array(fields)))
    limit = F.timestamp_seconds("timestamp") + F.expr(f"INTERVAL {FUTURE_TOLERANCE}")
    reason = (F.when(~F.col("st_known"), MALFORMED).when(F.col("st_created").isNull(), UNDATED)
              .when(F.col("st_created") > limit, FUTURE)
              .when(F.coalesce(F.size("st_tags"), F.lit(-1)) <= 0, UNTAGGED).otherwise(COUNTED))
    return out.withColumn("st_reason", reason).drop("st_known")


def reason_counts(column: str = "st_reason") -> list[Column]:
    """Aggregates for ``observe``: records, and how many have each reason not to count."""
    return [F.count(F.lit(1)).alias("records"),
            *(F.count(F.when(F.col(column) == r, 1)).alias(r) for r in (MALFORMED, UNDATED, FUTURE, UNTAGGED))]
