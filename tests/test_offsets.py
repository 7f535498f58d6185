import pytest
from pyspark.sql import functions as F

from larkspur.sources import topic


def test_end_offsets_adds_batch_share_to_every_partition():
    end = topic.end_offsets('{"tw": {"0": 10, "1": 20, "2": 30}}', 6)
    assert topic.parse_offsets(end) == ("tw", {0: 12, 1: 22, 2: 32})


def test_special_offsets_are_resolved_never_skipped(spark):
    special = '{"tw": {"0": -2, "1": 5, "2": -1, "3": -2}}'
    with pytest.raises(ValueError):
        topic.end_offsets(special, 4)
    with pytest.raises(ValueError):
        topic.offset_ranges(spark, special, special)
    recs = spark.createDataFrame([("k", "v", "tw", p, o, 0, 0) for p in range(3) for o in range(3, 10)], topic.RECORD_SCHEMA)
    start = topic.resolve_offsets(recs, special)
    assert topic.parse_offsets(start) == ("tw", {0: 3, 1: 5, 2: 10, 3: 0})
    ranges = topic.offset_ranges(spark, start, topic.end_offsets(start, 8))
    got = sorted((r.partition, r.offset) for r in topic.slice_records(recs, ranges).collect())
    assert got == [(0, 3), (0, 4), (1, 5), (1, 6)]


@pytest.mark.parametrize("bad", [None, "", "   ", "not json", '{"a": {"0": 1}, "b": {"0": 2}}', "[1, 2]"])
def test_invalid_offsets_raise(bad):
    with pytest.raises(ValueError):
        topic.parse_offsets(bad)


def test_batch_size_must_divide_over_partitions():
    with pytest.raises(ValueError):
        topic.end_offsets('{"tw": {"0": 0, "1": 0, "2": 0}}', 7)


def test_slice_is_half_open_per_partition(spark):
    recs = spark.createDataFrame(
        [("k", "v", "tw", p, o, 0, 0) for p in range(2) for o in range(10)], topic.RECORD_SCHEMA)
    start = '{"tw": {"0": 2, "1": 5}}'
    ranges = topic.offset_ranges(spark, start, topic.end_offsets(start, 6))
    got = sorted((r.partition, r.offset) for r in topic.slice_records(recs, ranges).collect())
    assert got == [(0, 2), (0, 3), (0, 4), (1, 5), (1, 6), (1, 7)]


def test_slice_plan_broadcasts_the_ranges_only(spark):
    recs = spark.range(100).select(F.lit("k").alias("key"), F.lit("v").alias("value"), F.lit("tw").alias("topic"),
                                   (F.col("id") % 3).cast("int").alias("partition"), F.col("id").alias("offset"),
                                   F.lit(0).cast("long").alias("timestamp"), F.lit(0).alias("timestampType"))
    start = '{"tw": {"0": 0, "1": 0, "2": 0}}'
    plan = topic.slice_records(recs, topic.offset_ranges(spark, start, topic.end_offsets(start, 30))) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_assign_slices_numbers_consecutive_batches(spark):
    recs = spark.createDataFrame(
        [("k", "v", "tw", p, o, 0, 0) for p in range(2) for o in range(10)], topic.RECORD_SCHEMA)
    start = '{"tw": {"0": 2, "1": 5}}'
    ranges = topic.offset_ranges(spark, start, topic.end_offsets(start, 6))
    got = sorted((r.partition, r.offset, r.slice) for r in topic.assign_slices(recs, ranges, 3).collect())
    assert got[:4] == [(0, 2, 0), (0, 3, 0), (0, 4, 0), (0, 5, 1)]
    assert [g for g in got if g[0] == 1] == [(1, 5, 0), (1, 6, 0), (1, 7, 0), (1, 8, 1), (1, 9, 1)]
