"""Intermediate tables in the shared folder, and Arrow batch sizes.

A stage that several later steps read is written once as Parquet below
``spark.checkpoint.dir`` (see ``larkspur.session``): lineage is cut there, and
a lost executor costs a re-read, not a re-run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larkspur.session import scratch_path

# Rows of a text table in one Arrow batch: bounds a Python worker's memory.
TEXT_ROWS_PER_BATCH = 256


# Shuffle files of an execution are of no use after its result has been written.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write(df: DataFrame, name: str) -> str:
    """Write ``df`` to a new scratch folder; returns its path."""
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to scratch and read back with its own schema."""
    schema = df.schema
    return df.sparkSession.read.schema(schema).parquet(write(df, name))


class Scratch:
    """Scratch tables for a block of steps; deleted at its end, when what was made of them is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def saved(self, df: DataFrame, name: str) -> DataFrame:
        schema = df.schema
        self.paths.append(write(df, name))
        return self.spark.read.schema(schema).parquet(self.paths[-1])

    def __exit__(self, *error) -> None:
        for p in self.paths:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Text goes to Python workers in batches of few rows, because one row can be megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS_PER_BATCH))


def without(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` without columns that clash (in any case) with those an operator adds."""
    low = {n.lower() for n in names}
    return docs.drop(*[c for c in docs.columns if c.lower() in low])
