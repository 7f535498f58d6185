import glob
import os

import pytest

from larkspur.operators import hashtags
from larkspur.plans import archive
from larkspur.session import scratch_path

SCHEMA = "date string, hour string, hashtag string, cnt long"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_rewrites_only_touched_hours(spark):
    root = scratch_path(spark, "t-archive")
    archive.write_partitions(spark.createDataFrame(
        [("2024-01-01", "09", "a", 2), ("2024-01-01", "10", "a", 1), ("2024-01-02", "00", "c", 7)], SCHEMA), root)
    untouched = os.listdir(f"{root}/date=2024-01-01/hour=10")
    batch = spark.createDataFrame([("2024-01-01", "09", "a", 3), ("2024-01-01", "09", "b", 1)], SCHEMA)
    assert archive.upsert(spark, batch, root) == 1
    assert rows(archive.read_archive(spark, root)) == [
        ("2024-01-01", "09", "a", 5), ("2024-01-01", "09", "b", 1),
        ("2024-01-01", "10", "a", 1), ("2024-01-02", "00", "c", 7)]
    assert os.listdir(f"{root}/date=2024-01-01/hour=10") == untouched


def test_first_batch_creates_the_archive(spark):
    root = scratch_path(spark, "t-archive-new")
    batch = spark.createDataFrame([("2024-01-01", "09", "a", 3)], SCHEMA)
    archive.upsert(spark, batch, root)
    assert rows(archive.read_archive(spark, root)) == [("2024-01-01", "09", "a", 3)]


def test_lookup_reads_only_touched_partitions(spark):
    root = scratch_path(spark, "t-archive-lookup")
    hours = [(f"2024-01-{d:02d}", f"{h:02d}", f"t{d}", d) for d in range(1, 30) for h in range(24)]
    archive.write_partitions(spark.createDataFrame(hours, SCHEMA), root, fresh=True)
    # Every file but the touched hour's is made unreadable: reading any of the 695 others would fail.
    for path in glob.glob(f"{root}/date=*/hour=*/*.parquet"):
        if "date=2024-01-10/hour=10" not in path:
            with open(path, "w") as f:
                f.write("not parquet")
    batch = spark.createDataFrame([("2024-01-10", "10", "z", 1)], SCHEMA)
    looked, n = archive.archived_for(spark, batch, root)
    plan = looked._jdf.queryExecution().executedPlan().toString()
    assert n == 1 and rows(looked) == [("2024-01-10", "10", "t10", 10)]
    assert "dynamicpruning" in plan.lower() and ">= 2024-01-10" in plan


def test_lookup_of_an_empty_batch(spark):
    root = scratch_path(spark, "t-archive-empty")
    archive.ensure_archive(spark, root)
    looked, n = archive.archived_for(spark, spark.createDataFrame([], SCHEMA), root)
    assert n == 0 and looked.count() == 0
    assert archive.upsert(spark, spark.createDataFrame([], SCHEMA), root, batch_id="e") == 0


def test_merge_is_order_insensitive(spark):
    a = spark.createDataFrame([("d", "01", "x", 1), ("d", "01", "y", 2)], SCHEMA)
    b = spark.createDataFrame([("d", "01", "x", 5)], SCHEMA)
    assert rows(hashtags.merge_counts(a, b)) == rows(hashtags.merge_counts(b, a)) == [
        ("d", "01", "x", 6), ("d", "01", "y", 2)]


def test_replayed_batch_is_skipped(spark):
    root = scratch_path(spark, "t-archive-replay")
    batch = spark.createDataFrame([("2024-01-01", "09", "a", 3)], SCHEMA)
    assert archive.upsert(spark, batch, root, batch_id="b-1") == 1
    assert archive.upsert(spark, batch, root, batch_id="b-1") == 0          # replay: no double count
    assert archive.upsert(spark, batch, root, batch_id="b/2 é") == 1
    assert rows(archive.read_archive(spark, root)) == [("2024-01-01", "09", "a", 6)]


@pytest.mark.parametrize("step", ["write_partitions", "_mark_done", "_drop"])
@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("other_first", [False, True])
def test_crash_at_any_step_then_replay(spark, monkeypatch, step, after, other_first):
    """A crash before or after each step of an upsert, then the same batch again, counts once."""
    root = scratch_path(spark, "t-archive-crash")
    archive.write_partitions(spark.createDataFrame([("2024-01-01", "09", "a", 2), ("2024-01-01", "10", "x", 5)], SCHEMA), root, fresh=True)
    batch = spark.createDataFrame([("2024-01-01", "09", "a", 3), ("2024-01-02", "00", "n", 1)], SCHEMA)
    second = spark.createDataFrame([("2024-01-01", "09", "a", 10)], SCHEMA)
    real = getattr(archive, step)

    def crash(*args, **kwargs):
        if after:
            real(*args, **kwargs)
        raise RuntimeError("crash")
    monkeypatch.setattr(archive, step, crash)
    with pytest.raises(RuntimeError):
        archive.upsert(spark, batch, root, batch_id="b-1")
    monkeypatch.setattr(archive, step, real)
    if other_first:                                       # another batch comes before the replay
        archive.upsert(spark, second, root, batch_id="b-2")
    archive.upsert(spark, batch, root, batch_id="b-1")
    archive.upsert(spark, second, root, batch_id="b-2")
    assert rows(archive.read_archive(spark, root)) == [
        ("2024-01-01", "09", "a", 15), ("2024-01-01", "10", "x", 5), ("2024-01-02", "00", "n", 1)]


from hypothesis import given, settings, strategies as st  # noqa: E402

_rows = st.lists(st.tuples(st.sampled_from(["d1", "d2"]), st.sampled_from(["00", "09"]),
                           st.sampled_from(["a", "b;c", "é"]), st.integers(min_value=1, max_value=50)),
                 min_size=0, max_size=6)


@settings(max_examples=10, deadline=None)
@given(_rows, _rows, _rows)
def test_merge_is_associative_and_commutative(spark, a, b, c):
    A, B, C = (spark.createDataFrame(x, SCHEMA) for x in (a, b, c))
    left = rows(hashtags.merge_counts(hashtags.merge_counts(A, B), C))
    right = rows(hashtags.merge_counts(A, hashtags.merge_counts(C, B)))
    assert left == right
    expected = {}
    for d, h, t, n in a + b + c:
        expected[(d, h, t)] = expected.get((d, h, t), 0) + n
    assert left == sorted((k[0], k[1], k[2], v) for k, v in expected.items())


def test_upsert_keeps_untouched_hours_under_static_session_default(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    prev = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        root = scratch_path(spark, "t-archive-static")
        archive.write_partitions(spark.createDataFrame(
            [("2024-01-01", "09", "a", 2), ("2024-01-01", "10", "a", 1)], SCHEMA), root, fresh=True)
        archive.upsert(spark, spark.createDataFrame([("2024-01-01", "09", "a", 3)], SCHEMA), root)
        assert rows(archive.read_archive(spark, root)) == [("2024-01-01", "09", "a", 5), ("2024-01-01", "10", "a", 1)]
    finally:
        spark.conf.set(key, prev)


def test_hot_hour_is_split_across_writers(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    prev = spark.conf.get(key)
    spark.conf.set(key, "1k")
    try:
        hot = [("2024-01-01", "09", f"tag{i}" * 20, i) for i in range(2000)] + [("2024-01-01", "10", "a", 1)]
        root = scratch_path(spark, "t-archive-hot")
        archive.write_partitions(spark.createDataFrame(hot, SCHEMA).repartition(8), root, fresh=True)
        files = [f for f in os.listdir(f"{root}/date=2024-01-01/hour=09") if f.endswith(".parquet")]
        assert len(files) >= 2
        assert rows(archive.read_archive(spark, root)) == sorted(hot)
    finally:
        spark.conf.set(key, prev)


def test_many_small_hours_are_written_by_several_tasks(spark):
    hours = [(f"2024-01-{d:02d}", f"{h:02d}", f"t{d}", d) for d in range(1, 11) for h in range(24)]
    root = scratch_path(spark, "t-archive-writers")
    archive.write_partitions(spark.createDataFrame(hours, SCHEMA).repartition(4), root, fresh=True)
    files = glob.glob(f"{root}/date=*/hour=*/*.parquet")
    assert len(files) == 240 and len({os.path.basename(f).split("-")[1] for f in files}) >= 2
    assert rows(archive.read_archive(spark, root)) == sorted(hours)


def test_upsert_leaves_no_scratch(spark, monkeypatch):
    made = []
    real = archive.scratch_path
    monkeypatch.setattr(archive, "scratch_path", lambda s, n: made.append(real(s, n)) or made[-1])
    root = scratch_path(spark, "t-archive-scratch")
    archive.upsert(spark, spark.createDataFrame([("2024-01-01", "09", "a", 3)], SCHEMA), root, batch_id="b")
    assert made and not any(os.path.exists(p) for p in made) and not glob.glob(f"{root}/{archive.STAGES}/*")
