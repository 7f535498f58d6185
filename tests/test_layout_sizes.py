"""Layouts whose tasks stay of bounded size, and that move and write few bytes."""

import glob
import math

from pyspark.sql import functions as F

from larkspur.functions import user_agent
from larkspur.plans import clustered, layouts
from larkspur.session import scratch_path
from larkspur.sources import bids as src


def test_more_rows_give_more_clustered_files(spark, monkeypatch):
    monkeypatch.setattr(clustered, "FILE_ROWS", 50, raising=False)
    df = spark.range(1000).select((F.col("id") % 31).cast("string").alias("c"), F.col("id").alias("n"))
    path = scratch_path(spark, "t-files")
    clustered.write_clustered(df, path, ("c", "n"), 4)
    files, total = clustered.files_for(spark, path, {"n": (0, 999)})
    assert total == len(files) >= 15
    assert max(r["rows"] for r in spark.read.parquet(f"{path}/{clustered.STATS}").collect()) < 250
    assert sorted(r["n"] for r in clustered.read_clustered(spark, path, df.schema, {"n": (10, 700)}).collect()) == list(range(10, 701))


def test_file_statistics_are_sparks_least_and_largest(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(clustered, "F", type("Seen", (), {"__getattr__": lambda _, k: asked.append(k) or getattr(F, k)})())
    odd = [None, "", "\U0001f600", "～", "a", "B"]
    data = [(odd[i % 6], [1.5, float("nan"), None, -0.5][i // 6 % 4], i if i % 5 else None) for i in range(300)] + [(None, None, None)] * 3
    df = spark.createDataFrame(data, "c string, x double, n int")
    path = scratch_path(spark, "t-stats")
    clustered.write_clustered(df, path, ("c", "x", "n"), 4)
    want = [f(c).alias(f"{name}_{c}") for c in ("c", "x", "n") for name, f in (("min", F.min), ("max", F.max))]
    want = (spark.read.schema(df.schema).parquet(path).groupBy(F.col("_metadata.file_path").alias("file"))
            .agg(*want, F.count(F.lit(1)).alias("rows")))
    got = spark.read.parquet(f"{path}/{clustered.STATS}")

    def plain(rows):
        return sorted(tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows.collect())
    assert got.columns == want.columns and plain(got) == plain(want) and got.count() > 1
    assert "count" not in asked          # rows per file are counted batch by batch, with nothing sorted


def test_text_layout_shuffles_no_derived_column_and_is_compressed(spark):
    agents = F.element_at(F.array(*[F.lit(u).cast("string") for u in src.USER_AGENTS]), (F.col("id") % len(src.USER_AGENTS)).cast("int") + 1)
    df = spark.range(500).select(F.col("id").cast("string").alias("bidid"), (F.col("id") % 13).cast("string").alias("cityid"),
                                 agents.alias("useragent"), F.lit("2013-10-19").alias("bid_date"))
    path = scratch_path(spark, "t-derived")
    layouts.write_layout(spark, df, "t_derived", fmt="csv", path=path, derived=user_agent.enrich)
    want = user_agent.enrich(df)
    got = layouts.read_layout(spark, path, want.schema, "csv").select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert glob.glob(f"{path}/*/*.csv.gz") and not glob.glob(f"{path}/*/*.csv")
