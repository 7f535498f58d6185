"""Driver test tables (one parquet file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
# Tables whose rows carry per-row parsing work (JSON, regex, text).
FACT_TABLES = {"lineitem", "events", "documents", "orders", "pages", "conversations"}


# Session setting: deal a scan of a fact table over so many tasks.  Unset, a scan keeps its own splits; it
# is for files that Spark cannot split (one row group) and is set by bench.py and the tests.
SCAN_PARTITIONS = "larkspur.scan.partitions"


def table(spark: SparkSession, sf_dir: str, name: str, parallel: bool = True) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    deal = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(deal)) if deal and parallel and name in FACT_TABLES else df
