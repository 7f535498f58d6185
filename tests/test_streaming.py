import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException

from larkspur.operators import hashtags
from larkspur.plans.delta_log import DeltaLog
from larkspur.plans.queries_hashtags import records
from larkspur.session import scratch_path
from larkspur.sources.topic import RECORD_SCHEMA
from larkspur.streaming import hashtag_stream as hs
from larkspur.streaming import queries_stream as qs


def totals(df):
    return sorted(tuple(r) for r in df.select("date", "hour", "hashtag", "cnt").collect())


def test_sum_of_deltas_equals_batch_count(spark, sf_dir):
    topic = qs.write_topic(spark, sf_dir)
    out, ckpt = scratch_path(spark, "t-s1"), scratch_path(spark, "t-ckpt")
    q = hs.run(hs.arrival_deltas(hs.record_stream(spark, topic, 2), out, ckpt))
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 2   # several micro-batches
    batch = hashtags.hourly_counts(hashtags.explode_hashtags_created(records(spark, sf_dir), keep=()))
    assert totals(hs.decoded_totals(spark, out)) == totals(batch)


def test_stream_merges_into_the_log_once(spark, sf_dir):
    topic = qs.write_topic(spark, sf_dir)
    root, ckpt = scratch_path(spark, "t-arch"), scratch_path(spark, "t-ckpt")
    q = hs.run(hs.archive_merge(hs.record_stream(spark, topic, max_files=2), root, ckpt))
    batches = len([p for p in q.recentProgress if p["numInputRows"] > 0])
    log = DeltaLog(spark, root)
    assert batches >= 7
    expected = totals(hashtags.batch_hourly_counts(records(spark, sf_dir)))
    assert totals(log.read()) == expected
    # Micro-batch 0 again, as a restarted query would run it: already done, nothing added.
    first = spark.createDataFrame([("2024-01-01", "00", "again", 1)], hashtags.STATS_SCHEMA)
    assert not log.append(first, ckpt, 0)
    assert totals(log.read()) == expected
    # Each row is written once per size class, not once per batch.
    m = log.manifest()[1]
    assert m["rows_written"] <= 2.5 * m["rows_in"]


def test_topic_files_are_in_time_order_and_batches_bounded_in_bytes(spark, sf_dir):
    topic = qs.write_topic(spark, sf_dir)
    seen = []
    for k in range(2):                                            # a second publication comes after the first
        files = sorted((os.path.getmtime(f), f) for f in glob.glob(f"{topic}/*.parquet"))
        spans = [pq.read_table(f)["timestamp"].to_numpy() for _, f in files]
        spans = [(s.min(), s.max()) for s in spans if len(s)]
        assert [f for _, f in files] == sorted(f for _, f in files)
        seen.append(spans)
        if not k:
            assert all(a[1] <= b[0] for a, b in zip(spans[:-1], spans[1:]))
            qs.write_topic(spark, sf_dir, path=topic)
    assert seen[1][:len(seen[0])] == seen[0]
    hours = []

    def note(batch, _):
        hours.append({(r["d"], r["h"]) for r in batch.selectExpr("from_unixtime(timestamp, 'yyyy-MM-dd') d", "from_unixtime(timestamp, 'HH') h").collect()})
    q = hs.record_stream(spark, qs.write_topic(spark, sf_dir), max_bytes=1).writeStream.foreachBatch(note) \
        .option("checkpointLocation", scratch_path(spark, "t-ckpt")).trigger(availableNow=True).start()
    hs.run(q)
    every = set().union(*hours)
    # A micro-batch touches its own stretch of hours only; neighbours share one at most.
    assert len(hours) == qs.TOPIC_FILES and sum(map(len, hours)) <= len(every) + len(hours)


def test_totals_from_state_and_closed_hours(spark, sf_dir):
    topic = qs.write_topic(spark, sf_dir)
    out, ckpt = scratch_path(spark, "t-tot"), scratch_path(spark, "t-ckpt")
    q = hs.run(hs.running_totals(hs.record_stream(spark, topic, max_files=4), out, ckpt, delay=qs.SLICE_DELAY))
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) >= 3 and hs.dropped_late(q) == 0
    assert totals(hs.latest_totals(spark, out, ckpt)) == totals(
        hashtags.hourly_counts(hashtags.explode_hashtags_created(records(spark, sf_dir), keep=())))
    keys = hs.latest_totals(spark, out, ckpt).count()
    state = [p["stateOperators"][0] for p in q.recentProgress]
    assert sum(s["numRowsRemoved"] for s in state) > 0           # hours behind the watermark left the state
    assert state[-1]["numRowsTotal"] < keys
    # What is read for the totals does not grow with the number of batches: a row per key.
    out2, ckpt2 = scratch_path(spark, "t-tot"), scratch_path(spark, "t-ckpt")
    hs.run(hs.running_totals(hs.record_stream(spark, topic, max_files=16), out2, ckpt2, delay=qs.SLICE_DELAY))
    rows = [hs.closed_totals(spark, o).count() + hs.open_totals(spark, c).count() for o, c in ((out, ckpt), (out2, ckpt2))]
    assert rows == [keys, keys]


def test_open_totals_before_any_batch(spark):
    assert hs.latest_totals(spark, scratch_path(spark, "none"), scratch_path(spark, "none")).count() == 0


@pytest.mark.parametrize("after", [False, True])
def test_crash_inside_a_batch(spark, sf_dir, after):
    topic = qs.write_topic(spark, sf_dir)
    out, ckpt = scratch_path(spark, "t-crash"), scratch_path(spark, "t-ckpt")
    with hs.changelog_state(spark):
        with pytest.raises(StreamingQueryException):
            hs.run(hs.running_totals(hs.record_stream(spark, topic, max_files=4), out, ckpt, delay=qs.SLICE_DELAY, wrap=hs.crash_in(2, after)))
        written = glob.glob(f"{out}/batch_id=2/*.parquet")
        assert bool(written) == after
        q = hs.run(hs.running_totals(hs.record_stream(spark, topic, max_files=4), out, ckpt, delay=qs.SLICE_DELAY))
        assert q.recentProgress[0]["batchId"] == 2                # the batch that failed is run again
        assert totals(hs.latest_totals(spark, out, ckpt)) == totals(
            hashtags.hourly_counts(hashtags.explode_hashtags_created(records(spark, sf_dir), keep=())))
    assert glob.glob(f"{ckpt}/state/0/0/*.changelog")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") .find("RocksDB") < 0


def test_arrival_windows_are_the_same_however_batches_fall(spark):
    topic = scratch_path(spark, "t-topic")
    base = 1704110400                                             # 2024-01-01 12:00:00, a window's start
    for second in range(0, 420, 10):                              # seven minutes of 10 s batches
        rows = [("u", _status_record("Mon Jan 01 10:00:10 +0000 2024", ["a"], 0)[1], "tw", 0, second, base + second + k, 0) for k in (0, 9)]
        spark.createDataFrame(rows, RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(topic)
    spark.createDataFrame([("c", qs.SENTINEL_VALUE, "tw", 0, 1, base + 10_000, 0)], RECORD_SCHEMA).write.mode("append").parquet(topic)
    results = []
    for files in (6, 11):
        out, ckpt = scratch_path(spark, "t-arr"), scratch_path(spark, "t-ckpt")
        q = hs.run(hs.arrival_windows(hs.record_stream(spark, topic, max_files=files), out, ckpt))
        assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 4
        results.append(sorted(tuple(r) for r in spark.read.parquet(out).collect()))
    assert results[0] == results[1] == [(f"2024-01-01 12:0{m}:00", "2024-01-01", "10", "a", n) for m, n in ((0, 36), (3, 36), (6, 12))]


def test_limited_second_stage(spark, sf_dir):
    topic = qs.write_topic(spark, sf_dir)
    s1, s2 = scratch_path(spark, "t-s1"), scratch_path(spark, "t-s2")
    hs.run(hs.arrival_deltas(hs.record_stream(spark, topic, max_files=4), s1, scratch_path(spark, "t-ckpt")))
    q = hs.run(hs.rollup_stage(hs.stats_record_stream(spark, s1, max_files=1), s2, scratch_path(spark, "t-ckpt")))
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 4
    summed = {r["stat_key"]: r["cnt"] for r in hs.sum_of_deltas(spark, s2).collect()}
    assert summed == {";".join(t[:3]): t[3] for t in totals(hashtags.hourly_counts(
        hashtags.explode_hashtags_created(records(spark, sf_dir), keep=())))}


def test_bounded_run_time_with_processing_time_trigger(spark, sf_dir):
    topic = qs.write_topic(spark, sf_dir)
    out, ckpt = scratch_path(spark, "t-timed"), scratch_path(spark, "t-ckpt")
    q = hs.arrival_deltas(hs.record_stream(spark, topic, 3), out, ckpt, bounded=False, interval="1 second")
    hs.run(q, timeout_s=20)
    assert not q.isActive
    assert spark.read.parquet(out).count() > 0


def catalog_content(spark):
    return ({t.name for t in spark.catalog.listTables()}, {d.name for d in spark.catalog.listDatabases()},
            spark.catalog.currentDatabase())


def test_catalog_database_and_view(spark, sf_dir):
    from larkspur.plans import catalog
    from larkspur.plans.queries_bids import bids
    before = catalog_content(spark)
    with catalog.temporary_database(spark, "logs_t", scratch_path(spark, "t-db")) as db, \
            catalog.user_agents_view(spark, bids(spark, sf_dir)) as view:
        assert spark.catalog.currentDatabase() == db
        v = spark.table(view).select("cityid", "device", "os", "browser")
    assert catalog_content(spark) == before
    assert v.count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()


def test_queries_leave_the_catalog_as_it_was(spark, sf_dir):
    import __spark_entry__ as ent
    before = catalog_content(spark)
    for name in ("user_agents_view", "ua_lateral", "bids_layout_orc", "bids_layout_text", "bids_lookup_bloom"):
        ent.queries()[name](spark, sf_dir).count()
        assert catalog_content(spark) == before, name


def _status_record(created, tags, offset):
    import json
    v = json.dumps({"created_at": created, "entities": {"hashtags": [{"text": t, "indices": [0, 1]} for t in tags]}})
    arrived = 1704110400 + 86400                     # 2024-01-02 12:00 UTC
    return ("u", v, "tw", 0, offset, arrived, 0)


def test_event_windows_drop_data_behind_the_watermark(spark):
    from larkspur.sources.topic import RECORD_SCHEMA
    topic, out, ckpt = scratch_path(spark, "t-topic"), scratch_path(spark, "t-win"), scratch_path(spark, "t-ckpt")
    batches = [
        [_status_record("Mon Jan 01 10:00:10 +0000 2024", ["a"], 0),
         _status_record("Mon Jan 01 10:01:00 +0000 2024", ["a", "b"], 1)],
        [_status_record("Mon Jan 01 11:00:00 +0000 2024", [], 2)],            # moves event time
        [_status_record("Mon Jan 01 10:02:00 +0000 2024", ["a"], 3),          # late: behind the watermark
         _status_record("Mon Jan 01 12:00:00 +0000 2024", [], 4)],
    ]
    late = 0
    for rows in batches:
        spark.createDataFrame(rows, RECORD_SCHEMA).write.mode("append").parquet(topic)
        q = hs.run(hs.event_windows(hs.record_stream(spark, topic, 100), out, ckpt, length="3 minutes", delay="10 minutes"))
        late += hs.dropped_late(q)
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    # The late "a" at 10:02 falls in the already-closed 10:00 window: not counted, but counted as dropped.
    assert got == [("2024-01-01 10:00:00", "a", 2), ("2024-01-01 10:00:00", "b", 1)]
    assert late == 1


def test_a_status_from_the_future_does_not_close_the_stream(spark):
    from larkspur.sources.topic import RECORD_SCHEMA
    topic, out, ckpt = scratch_path(spark, "t-topic"), scratch_path(spark, "t-fut"), scratch_path(spark, "t-ckpt")
    for rows in ([_status_record("Mon Jan 01 10:00:10 +0000 2024", ["a"], 0), _status_record("Fri Jan 01 00:00:00 +0000 2100", ["z"], 1)],
                 [_status_record("Mon Jan 01 10:05:00 +0000 2024", ["b"], 2)], [_status_record("Mon Jan 01 10:06:00 +0000 2024", ["c"], 3)]):
        spark.createDataFrame(rows, RECORD_SCHEMA).write.mode("append").parquet(topic)
        hs.run(hs.running_totals(hs.record_stream(spark, topic, 100), out, ckpt))
    assert {r["hashtag"] for r in hs.latest_totals(spark, out, ckpt).collect()} == {"a", "b", "c"}


def test_kafka_options_are_rate_limited_and_acknowledged():
    source = hs.topic_options("broker:9092", "statuses", 1000)
    assert source["maxOffsetsPerTrigger"] == "1000" and source["startingOffsets"] == "earliest"
    sink = hs.kafka_sink_options("broker:9092", "out", "/ckpt")
    assert sink["kafka.acks"] == "all" and sink["topic"] == "out" and sink["checkpointLocation"] == "/ckpt"
