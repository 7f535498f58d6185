"""Partitioned, bucketed and sorted table layouts for the bid log.

One writer covers every variant (text/CSV or ORC, partition column, bucket
count, sort columns, compression, bloom filters).  Tables are external
(``path`` in the shared folder), so no warehouse directory is needed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.session import scratch_path


def bucket_id(col: str, buckets: int):
    """Spark's bucket of a value: pmod(murmur3(col), buckets)."""
    return F.pmod(F.hash(F.col(col)), F.lit(buckets))


def rebalanced(df: DataFrame, partition_by: str | None, bucket_by: str, buckets: int) -> DataFrame:
    """REBALANCE rows on (partition value, bucket id) before a bucketed write."""
    staged = df.withColumn("__bucket", bucket_id(bucket_by, buckets))
    return staged.hint("rebalance", *([partition_by] if partition_by else []), "__bucket").drop("__bucket")


def write_layout(spark: SparkSession, df: DataFrame, name: str, fmt: str = "orc",
                 partition_by: str | None = "bid_date", buckets: int = 4, bucket_by: str = "cityid",
                 sort_by: tuple[str, ...] = ("useragent",), compression: str | None = None,
                 bloom_columns: tuple[str, ...] = (), path: str | None = None,
                 derived: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Write ``df`` as an external table; returns the table name.

    ``derived`` adds columns that follow from a row alone, after the shuffle, which need not carry them.

    Rows are rebalanced on (partition value, bucket id): every
    (partition, bucket) file set comes from its own writer task(s), AQE
    splits a hot bucket across several tasks (several files of one bucket
    are valid for Spark's bucketed reads) and merges small ones.
    """
    table = f"{name}_{uuid.uuid4().hex[:10]}"
    path = path or scratch_path(spark, name)
    staged = rebalanced(df, partition_by, bucket_by, buckets)
    if derived:
        staged = derived(staged)
    w = staged.write.format(fmt).mode("overwrite").option("path", path)
    if fmt == "csv":
        # TAB-separated; NULL as \N, an empty string stays "" (quoted) so both survive a re-read.
        # Gzip, for text repeats much; a file is what one task wrote, so none need be split to be read.
        compression = compression or "gzip"
        w = w.option("sep", "\t").option("nullValue", "\\N")
    if compression is not None:
        w = w.option("compression", compression)
    if bloom_columns:
        w = w.option("orc.bloom.filter.columns", ",".join(bloom_columns))
    if partition_by:
        w = w.partitionBy(partition_by)
    w.bucketBy(buckets, bucket_by).sortBy(*sort_by).saveAsTable(table)
    return table


@contextmanager
def layout(spark: SparkSession, df: DataFrame, name: str, **options):
    """``write_layout`` for a block: yields (table, path) and drops the table afterwards.

    The files stay below the scratch folder of the application, so frames read from the path
    (``read_layout``) outlive the block and no table is left in the catalog.
    """
    path = scratch_path(spark, name)
    table = write_layout(spark, df, name, path=path, **options)
    try:
        yield table, path
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def read_layout(spark: SparkSession, path: str, schema, fmt: str = "orc") -> DataFrame:
    """The rows of a layout's files, with the declared schema."""
    r = spark.read.schema(schema)
    if fmt == "csv":
        r = r.option("sep", "\t").option("nullValue", "\\N")
    return r.format(fmt).load(path)


@contextmanager
def dynamic_partition_overwrite(spark: SparkSession):
    """Session-scoped dynamic partition overwrite.

    ``insertInto`` ignores a per-write ``partitionOverwriteMode`` option and
    follows the session setting, where the static default would delete every
    partition not present in the new data.
    """
    key = "spark.sql.sources.partitionOverwriteMode"
    prev = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, prev)


def insert_overwrite(spark: SparkSession, df: DataFrame, table: str, partition_by: str | None = None,
                     bucket_by: str | None = None, buckets: int | None = None) -> None:
    """INSERT OVERWRITE with dynamic partitions: only the partitions present in
    ``df`` are replaced (e.g. loading a new day); columns are matched by name.
    With the table's bucket spec given, rows are rebalanced like ``write_layout``."""
    cols = spark.table(table).columns
    if bucket_by and buckets:
        df = rebalanced(df, partition_by, bucket_by, buckets)
    with dynamic_partition_overwrite(spark):
        df.select(*cols).write.mode("overwrite").insertInto(table)
