"""Delimited text scans and sinks with declared schemas (no inference)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.operators import hashtags


# Characters that end a field or a row, and how they are written (backslash first).
ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\0", "\\0"))


def escaped(value: Column) -> Column:
    """Text on one line: backslash, newline, return, TAB and NUL as backslash sequences."""
    for char, written in ESCAPES:
        value = F.replace(value, F.lit(char), F.lit(written))
    return value


def unescaped(value: Column) -> Column:
    """The inverse of ``escaped``: pairs are read from the left, so ``\\\\n`` is a backslash and an n."""
    # NUL never occurs in escaped text, so it can stand for a backslash meanwhile.
    value = F.replace(value, F.lit("\\\\"), F.lit("\0b"))
    value = F.replace(value, F.lit("\\0"), F.lit("\0z"))
    for char, written in ESCAPES[1:4]:
        value = F.replace(value, F.lit(written), F.lit(char))
    value = F.replace(value, F.lit("\0b"), F.lit("\\"))
    return F.replace(value, F.lit("\0z"), F.lit("\0"))


def write_stats_csv(stats: DataFrame, path: str) -> None:
    """Quoted CSV; hashtags are escaped, so a row is one line and the files stay splittable."""
    stats.select("date", "hour", escaped(F.col("hashtag")).alias("hashtag"), "cnt").write.mode("overwrite") \
        .option("quoteAll", "true").option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)


def read_stats_csv(spark: SparkSession, path: str) -> DataFrame:
    """Stats CSV with the forced schema, so an hour "09" stays text."""
    rows = spark.read.schema(hashtags.STATS_SCHEMA).option("quote", '"').option("escape", '"').csv(path)
    return rows.withColumn("hashtag", unescaped(F.col("hashtag")))


def read_records_csv(spark: SparkSession, path: str) -> DataFrame:
    """Topic records stored as ``;``-separated lines without quoting."""
    from larkspur.sources.topic import RECORD_SCHEMA
    return spark.read.schema(RECORD_SCHEMA).option("sep", ";").option("quote", "").csv(path)


# Text-table conventions: TAB fields, newline rows, no quoting, NULL as \N
# (so an empty string stays an empty string).
NULL_MARK = "\\N"


def read_tsv(spark: SparkSession, path: str, schema, escapes: bool = False) -> DataFrame:
    """Tab-separated text with text-table semantics; ``escapes`` reads what ``write_tsv`` wrote.

    Lines are split on TAB (trailing empty fields kept); an empty field is
    an empty string, ``\\N`` is NULL, a missing trailing field is NULL and a
    value that does not fit a non-string column becomes NULL.
    """
    parts = F.split(F.col("value"), "\t", -1)
    cols = []
    for i, f in enumerate(schema.fields):
        v = F.get(parts, i)
        v = F.when(v != F.lit(NULL_MARK), unescaped(v) if escapes else v)
        if not isinstance(f.dataType, T.StringType):
            v = v.try_cast(f.dataType)
        cols.append(v.alias(f.name))
    return spark.read.text(path).select(*cols)


def write_tsv(df: DataFrame, path: str) -> None:
    """One line per row; TAB, newline, return, NUL and backslash in a value are escaped."""
    fields = [F.coalesce(escaped(F.col(f.name)) if isinstance(f.dataType, T.StringType) else F.col(f.name).cast("string"),
                         F.lit(NULL_MARK)) for f in df.schema.fields]
    df.select(F.concat_ws("\t", *fields).alias("value")).write.mode("overwrite").text(path)
