"""Date/hour-partitioned Parquet archive of hashtag counts, with upsert.

Merge = read only the touched (date, hour) partitions, UNION ALL the batch, sum per key, stage
the merged rows below the archive, then dynamically overwrite just those partitions.
Untouched partitions are neither read nor rewritten.

A batch with an id can be run again after a crash at any point: a finished stage is published
again as it is (publishing is an overwrite, so twice is once), an unfinished stage is built
anew from the unchanged archive, and a batch with a completion mark is skipped.  One writer
at a time is assumed; it finishes a stage that another batch left behind before its own.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import hashtags
from larkspur.session import scratch_path

PARTITION_COLS = ["date", "hour"]
# Leading underscore: invisible to readers of the archive data.
STAGES, DONE = "_stages", "_done"


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """Whole archive with the forced schema (no inference: "09" stays "09")."""
    return spark.read.schema(hashtags.STATS_SCHEMA).parquet(root).select(*hashtags.STATS_KEYS, "cnt")


def ensure_archive(spark: SparkSession, root: str) -> None:
    """Create an empty archive root when there is none yet."""
    if not _exists(spark, root):
        spark.createDataFrame([], hashtags.STATS_SCHEMA).write.mode("append") \
            .partitionBy(*PARTITION_COLS).parquet(root)


@contextmanager
def _writers_for_files(spark: SparkSession):
    """Let AQE keep as many writers as there are cores, however few bytes: what an hour costs is its file, not its size."""
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key)
    spark.conf.set(key, "1b")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_partitions(stats: DataFrame, root: str, fresh: bool = False) -> None:
    """Overwrite exactly the (date, hour) partitions present in ``stats``.

    ``fresh=True`` creates a new archive: a plain write that fails if the
    root exists, without the staging and per-partition moves of a dynamic
    overwrite.  REBALANCE lets AQE write a small hour by one task and split a hot one over several.
    """
    w = stats.select(*hashtags.STATS_KEYS, "cnt").hint("rebalance", *PARTITION_COLS).write
    if fresh:
        w = w.mode("errorifexists")
    else:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with _writers_for_files(stats.sparkSession):
        w.partitionBy(*PARTITION_COLS).parquet(root)


def archived_for(spark: SparkSession, batch: DataFrame, root: str) -> tuple[DataFrame, int]:
    """Archive rows of the hours touched by ``batch`` and the touched-hour count.

    The touched hours (one row each) are written to scratch once; their date
    bounds become constants on both sides of the semi join, so the scan lists the dates between them
    only, and the selective filter on the hours makes Spark prune the rest at run time.
    """
    return _archived_for(spark, batch, root, scratch_path(spark, "touched-hours"))


def _archived_for(spark: SparkSession, batch: DataFrame, root: str, path: str) -> tuple[DataFrame, int]:
    """``archived_for`` with the touched hours at ``path``, to be kept until the rows have been read."""
    hashtags.active_hours(batch).write.parquet(path)
    hours = spark.read.schema("date string, hour string").parquet(path)
    lo, hi, n = hours.agg(F.min("date"), F.max("date"), F.count("*")).first()
    if not n:
        return read_archive(spark, root).limit(0), 0
    return hashtags.touched(read_archive(spark, root), hours, (lo, hi)), n


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _drop(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _mark_done(spark: SparkSession, root: str, name: str) -> None:
    fs, p = _fs(spark, f"{root}/{DONE}/{name}")
    fs.create(p, True).close()


def _publish(spark: SparkSession, root: str, name: str) -> None:
    """Overwrite the staged partitions, mark the batch done, drop its stage (each step repeatable)."""
    stage = f"{root}/{STAGES}/{name}"
    write_partitions(spark.read.schema(hashtags.STATS_SCHEMA).parquet(stage), root)
    _mark_done(spark, root, name)
    _drop(spark, stage)


def _finish_others(spark: SparkSession, root: str, name: str) -> None:
    """Publish complete stages left by a crash, and drop incomplete ones, of other batches."""
    fs, p = _fs(spark, f"{root}/{STAGES}")
    for s in fs.listStatus(p) if fs.exists(p) else []:          # at most the stages of crashed runs
        other = s.getPath().getName()
        if other == name:
            continue
        if _exists(spark, f"{root}/{STAGES}/{other}/_SUCCESS") and not _exists(spark, f"{root}/{DONE}/{other}"):
            _publish(spark, root, other)
        else:
            _drop(spark, f"{root}/{STAGES}/{other}")


def upsert(spark: SparkSession, batch: DataFrame, root: str, batch_id: str | None = None) -> int:
    """Merge batch counts into the archive; returns the number of touched hours (0: nothing to do).

    Without a ``batch_id`` a repeated call counts as a new batch.
    """
    ensure_archive(spark, root)
    name = quote(batch_id, safe="") if batch_id is not None else uuid.uuid4().hex
    _finish_others(spark, root, name)
    if _exists(spark, f"{root}/{DONE}/{name}"):
        _drop(spark, f"{root}/{STAGES}/{name}")
        return 0
    stage = f"{root}/{STAGES}/{name}"
    if not _exists(spark, f"{stage}/_SUCCESS"):
        counted, hours = scratch_path(spark, "batch-counts"), scratch_path(spark, "touched-hours")
        batch.select(*hashtags.STATS_KEYS, "cnt").write.parquet(counted)
        counts = spark.read.schema(hashtags.STATS_SCHEMA).parquet(counted)
        archived, touched = _archived_for(spark, counts, root, hours)
        if touched:
            hashtags.merge_counts(counts, archived).write.mode("overwrite").parquet(stage)
        _drop(spark, counted)
        _drop(spark, hours)
        if not touched:
            return 0
    else:                                                   # left complete by a crash
        touched = hashtags.active_hours(spark.read.schema(hashtags.STATS_SCHEMA).parquet(stage)).count()
    _publish(spark, root, name)
    return touched
