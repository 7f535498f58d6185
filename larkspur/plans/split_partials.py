"""Stored partial counts of booking markets, keyed by input file and block.

A split (a block of a text file, from Spark's file metadata columns) contributes one group of rows per
run.  The sum takes each split's rows from the last run that read it, so reading a split again
replaces what it gave before and never adds to it.  A run is one committed folder: one that
failed half way is not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import couples
from larkspur.plans.archive import _exists, _fs
from larkspur.sources import bookings

SCHEMA = "file string, block bigint, market_key string, cnt bigint"


class SplitPartials:
    """Partial counts below one folder; the split size is fixed when it is made, because blocks are compared by their start."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _runs(self) -> list[int]:
        fs, p = _fs(self.spark, self.root)
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        numbers = [int(n.split("-")[1]) for n in names if n.startswith("run-")]
        return sorted(n for n in numbers if _exists(self.spark, f"{self._run(n)}/_SUCCESS"))

    def _run(self, number: int) -> str:
        size = self.spark.conf.get("spark.sql.files.maxPartitionBytes").lower()
        return f"{self.root}/run-{number:08d}-{size}"

    def _check_split_size(self) -> None:
        fs, p = _fs(self.spark, self.root)
        suffix = self._run(0).rsplit("-", 1)[1]
        if fs.exists(p) and any(not s.getPath().getName().endswith(f"-{suffix}") for s in fs.listStatus(p)):
            raise ValueError("the stored partials were made with another spark.sql.files.maxPartitionBytes")

    def load(self, lines_path: str, where: Column | None = None) -> int:
        """Count the lines of the splits below ``lines_path`` that meet ``where`` (on ``file`` and ``block``); the run's number.

        Every split read leaves rows, if only one without a key, so that a split that has nothing to
        count any more replaces what it counted before.
        """
        self._check_split_size()
        number = max(self._runs(), default=-1) + 1
        lines = self.spark.read.text(lines_path).select(
            "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
        lines = lines if where is None else lines.where(where)
        v = F.split("value", ",", -1)
        fits = (F.size(v) == bookings.N_VALUES) & (F.get(v, bookings.ADULTS) == "2")
        key = couples.market_key(*(F.get(v, i) for i in (bookings.CONTINENT, bookings.COUNTRY, bookings.MARKET)))
        (lines.select("file", "block", F.when(fits & (key != couples.KEY_DELIM * 2), key).alias("market_key"))
         .groupBy("file", "block", "market_key").agg(F.count(F.lit(1)).alias("cnt"))
         .write.mode("overwrite").parquet(self._run(number)))
        return number

    def partials(self) -> DataFrame:
        """(file, block, market_key, cnt): of each split the rows of the last run that read it."""
        runs = self._runs()
        if not runs:
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(*map(self._run, runs)).withColumn(
            "run", F.regexp_extract(F.col("_metadata.file_path"), r"/run-(\d+)-[^/]*/[^/]*$", 1).cast("int"))
        last = rows.groupBy("file", "block").agg(F.max("run").alias("run"))
        return rows.join(last, ["file", "block", "run"], "left_semi").drop("run")

    def counts(self) -> DataFrame:
        """(market_key, cnt) over all splits."""
        return (self.partials().where(F.col("market_key").isNotNull())
                .groupBy("market_key").agg(F.sum("cnt").cast("bigint").alias("cnt")))
