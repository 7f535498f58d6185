import glob
import os

from pyspark.sql import functions as F

from larkspur.plans import layouts


def frame(spark, n=400):
    return spark.range(n).select(
        F.col("id").cast("string").alias("bidid"), (F.col("id") % 13).cast("string").alias("cityid"),
        F.concat(F.lit("ua"), (F.col("id") % 7).cast("string")).alias("useragent"),
        F.when(F.col("id") % 2 == 0, "2013-10-19").otherwise("2013-10-20").alias("bid_date"),
        F.when(F.col("id") % 5 == 0, "Tablet").otherwise("Computer").alias("device"))


def test_partitioned_bucketed_files(spark):
    t = layouts.write_layout(spark, frame(spark), "t_layout", fmt="orc", partition_by="bid_date", buckets=4)
    path = spark.sql(f"DESCRIBE FORMATTED {t}").where("col_name = 'Location'").collect()[0].data_type
    path = path.replace("file:", "")
    for part in ("bid_date=2013-10-19", "bid_date=2013-10-20"):
        files = [f for f in os.listdir(os.path.join(path, part)) if f.endswith(".orc")]
        bucket_ids = {f.split("_")[-1].split(".")[0] for f in files}
        assert 1 <= len(bucket_ids) <= 4
    assert spark.table(t).count() == 400


def test_bucketed_tables_join_without_exchange(spark):
    a = layouts.write_layout(spark, frame(spark), "t_a", fmt="orc", partition_by=None, buckets=4)
    b = layouts.write_layout(spark, frame(spark), "t_b", fmt="orc", partition_by=None, buckets=4)
    j = spark.table(a).join(spark.table(b).select("cityid", F.col("bidid").alias("b2")), "cityid")
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    assert j.count() == sum(c * c for c in [31] * 10 + [30] * 3)


def test_uncompressed_orc_and_bloom_filters(spark):
    t = layouts.write_layout(spark, frame(spark), "t_plain", fmt="orc", partition_by="bid_date", buckets=2,
                             compression="none", bloom_columns=("device",))
    path = spark.sql(f"DESCRIBE FORMATTED {t}").where("col_name = 'Location'").collect()[0].data_type
    files = glob.glob(path.replace("file:", "") + "/*/*.orc")
    assert files and all(".snappy." not in f and ".zlib." not in f for f in files)
    q = spark.table(t).where("device = 'Tablet'")
    assert "PushedFilters: [IsNotNull(device), EqualTo(device,Tablet)]" in \
        q._jdf.queryExecution().executedPlan().toString()
    assert q.count() == 80


def test_text_layout_keeps_empty_strings(spark):
    df = frame(spark, 10).withColumn("useragent", F.when(F.col("bidid") == "1", "").otherwise(F.col("useragent")))
    t = layouts.write_layout(spark, df, "t_text", fmt="csv", partition_by="bid_date", buckets=2)
    assert spark.table(t).where("useragent = ''").count() == 1


def test_insert_overwrite_replaces_only_new_partitions(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    prev = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        t = layouts.write_layout(spark, frame(spark), "t_ins", fmt="orc", partition_by="bid_date", buckets=2)
        new_day = frame(spark, 6).withColumn("bid_date", F.lit("2013-10-20")).withColumn("useragent", F.lit("new"))
        layouts.insert_overwrite(spark, new_day, t)
        counts = {r.bid_date: r["count"] for r in spark.table(t).groupBy("bid_date").count().collect()}
        assert counts == {"2013-10-19": 200, "2013-10-20": 6}
        assert spark.conf.get(key) == "static"
    finally:
        spark.conf.set(key, prev)
