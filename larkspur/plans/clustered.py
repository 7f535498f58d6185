"""A layout clustered on several columns at once, whose readers skip files.

Each column's values fall into 2**bits buckets of about equal size (bounds from a sample of at most
``SAMPLE`` rows; they steer the order only).  The bits of the bucket numbers are interleaved to a
Z-order key, files are ranges of it, and so every file spans a small box of all columns.  The least
and largest value of each column per file are kept beside the data; a reader opens the files that can hold
a row of its ranges, whichever of the columns they are on.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 20_000
FILE_ROWS = 200_000              # a file, which one task sorts, has about so many rows at most
BITS = 6
STATS = "_file_stats"            # leading underscore: invisible to readers of the data


def bounds(df: DataFrame, columns: tuple[str, ...], n: int, bits: int = BITS) -> dict[str, list]:
    """For each column up to 2**bits - 1 ascending values that cut a sample of its ``n`` rows into equal parts."""
    sample = df.select(*columns)
    if n > SAMPLE:
        sample = sample.where(F.pmod(F.xxhash64(*df.columns), F.lit(1 << 30)) < int((1 << 30) * SAMPLE / n)).limit(2 * SAMPLE)
    rows = sample.collect()
    out = {}
    for i, c in enumerate(columns):
        values = sorted(r[i] for r in rows if r[i] is not None)
        cuts = [values[len(values) * k // (1 << bits)] for k in range(1, 1 << bits)] if values else []
        out[c] = sorted(set(cuts))
    return out


def bucket(col: Column, cuts: list, bits: int = BITS) -> Column:
    """How many of the ascending ``cuts`` a value reaches, by binary search, spread over 0 to 2**bits - 1; null is 0.

    Spread, because a column of few values would else leave the high bits of its number, and of the key, empty.
    """
    def search(a: int, z: int) -> Column:
        if a == z:
            return F.lit(a * ((1 << bits) - 1) // max(1, len(cuts)))
        mid = (a + z) // 2
        return F.when(col >= F.lit(cuts[mid]), search(mid + 1, z)).otherwise(search(a, mid))
    return search(0, len(cuts))


def interleaved(buckets: list[Column], bits: int = BITS) -> Column:
    """The bits of the bucket numbers in turn, most significant first."""
    key = F.lit(0).cast("bigint")
    for b in range(bits - 1, -1, -1):
        for c in buckets:
            key = F.shiftleft(key, 1) + F.shiftright(c, b).bitwiseAND(1).cast("bigint")
    return key


def _least_largest(values: pa.Array) -> tuple[pa.Scalar, pa.Scalar]:
    """The least and largest value in Spark's order, where NaN is the largest; null if there is none."""
    low, high = (pc.min_max(values)[k] for k in ("min", "max"))
    if pa.types.is_floating(values.type) and pc.any(pc.is_nan(values)).as_py():
        high = pa.scalar(float("nan"), values.type)
        low = high if pc.all(pc.is_nan(values)).as_py() else low
    return low, high


def _batch_stats(names: list[str]):
    """Of rows (file, columns) the (file, least and largest of each column, rows) of each batch.

    Spark's own least and largest of strings per file would sort all the rows of a task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in pc.unique(batch.column(0)):
                rows = batch.filter(pc.equal(batch.column(0), file))
                ends = [pa.array([v], c.type) for c in rows.columns[1:] for v in _least_largest(c)]
                yield pa.RecordBatch.from_arrays([pa.array([file.as_py()]), *ends, pa.array([rows.num_rows], pa.int64())],
                                                 names=["file", *names, "rows"])
    return run


def write_clustered(df: DataFrame, path: str, columns: tuple[str, ...], files: int, bits: int = BITS) -> None:
    """Write ``df`` as ``files`` Parquet files clustered on ``columns``, and their statistics.

    There are more files where one would have over ``FILE_ROWS`` rows.  Rows of one key, however many, spread over
    files by a hash of the row.
    """
    n = df.count()
    files = max(files, -(-n // FILE_ROWS))
    cuts = bounds(df, columns, n, bits)
    key = interleaved([bucket(F.col(c), cuts[c], bits) for c in columns], bits)
    (df.withColumns({"__key": key, "__tie": F.xxhash64(*df.columns)})
     .repartitionByRange(files, "__key", "__tie").sortWithinPartitions("__key", *columns).drop("__key", "__tie")
     .write.parquet(path))
    spark = df.sparkSession
    written = spark.read.schema(df.schema).parquet(path)
    read = written.select(F.col("_metadata.file_path").alias("file"), *columns)
    kinds = [f"{name}_{c}" for c in columns for name in ("min", "max")]
    parts = read.mapInArrow(_batch_stats(kinds), T.StructType(
        [T.StructField("file", T.StringType()), *[T.StructField(k, df.schema[k[4:]].dataType) for k in kinds], T.StructField("rows", T.LongType())]))
    stats = [(F.min if k.startswith("min_") else F.max)(k).alias(k) for k in kinds]
    parts.groupBy("file").agg(*stats, F.sum("rows").alias("rows")).coalesce(1).write.parquet(f"{path}/{STATS}")


def files_for(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> tuple[list[str], int]:
    """(files that can hold a row within all ``ranges``, number of files); a range is (least, largest), both included."""
    stats = spark.read.parquet(f"{path}/{STATS}")
    meets = F.lit(True)
    for c, (low, high) in ranges.items():
        meets = meets & (F.col(f"min_{c}") <= F.lit(high)) & (F.col(f"max_{c}") >= F.lit(low))
    return [r["file"] for r in stats.where(meets).select("file").collect()], stats.count()


def read_clustered(spark: SparkSession, path: str, schema, ranges: dict[str, tuple]) -> DataFrame:
    """The rows within all ``ranges``, from the files that can hold some."""
    files, _ = files_for(spark, path, ranges)
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for c, (low, high) in ranges.items():
        rows = rows.where(F.col(c).between(F.lit(low), F.lit(high)))
    return rows
