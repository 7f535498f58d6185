"""A topic as a folder of Parquet files in time order.

File streams take the oldest files first, by modification time.  Files written by one job finish in any
order, so they are written aside, stamped in the order of their time ranges and then moved into
the topic: a micro-batch bounded in bytes then holds a stretch of time, not a sample of all of it.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def in_time_order(rows: DataFrame, files: int, *order: str) -> DataFrame:
    """``rows`` in ``files`` ranges of ``order``, each sorted: one scan and one shuffle.

    Put before costly projections: the sample that finds the ranges runs what stands before it twice.
    """
    return rows.repartitionByRange(files, *order).sortWithinPartitions(*order)


def publish(records: DataFrame, path: str) -> list[str]:
    """Append the files of ``records``, whose partitions are in time order, to the topic folder; their names, oldest first."""
    spark = records.sparkSession
    staged = f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    records.write.parquet(staged)
    fs, folder = _fs(spark, path)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    there = [s.getModificationTime() for s in fs.listStatus(folder) if s.isFile()]
    stamp = max([int(time.time() * 1000), *(t + 1 for t in there)])
    parts = sorted(s.getPath().getName() for s in fs.listStatus(jvm_path(staged)) if s.getPath().getName().startswith("part-"))
    names = []
    for k, part in enumerate(parts):
        source, name = jvm_path(f"{staged}/{part}"), f"{stamp + k:015d}-{part}"
        fs.setTimes(source, stamp + k, -1)
        if not fs.rename(source, jvm_path(f"{path.rstrip('/')}/{name}")):
            raise RuntimeError(f"cannot move {part} into {path}")
        names.append(name)
    fs.delete(jvm_path(staged), True)
    return names


def size_in_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()
