"""The log-structured archive: sums, folds, pruning, crashes at every step."""

import glob
import json
import math

import pytest

from larkspur.operators import hashtags
from larkspur.plans import delta_log
from larkspur.plans.delta_log import DeltaLog
from larkspur.session import scratch_path

SCHEMA = hashtags.STATS_SCHEMA


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def batch(spark, k, n=4):
    return spark.createDataFrame([(f"2024-01-{1 + k % 9:02d}", f"{h:02d}", f"t{h}", k + 1) for h in range(n)], SCHEMA)


def expected(ks, n=4):
    out = {}
    for k in ks:
        for h in range(n):
            key = (f"2024-01-{1 + k % 9:02d}", f"{h:02d}", f"t{h}")
            out[key] = out.get(key, 0) + k + 1
    return sorted((*key, v) for key, v in out.items())


def test_sums_over_runs_and_writes_each_row_few_times(spark):
    log, n = DeltaLog(spark, scratch_path(spark, "t-log")), 20
    for k in range(n):
        assert log.append(batch(spark, k), "s", k)
    assert rows(log.read()) == expected(range(n))
    m = log.manifest()[1]
    assert m["rows_in"] == 4 * n and m["rows_written"] <= m["rows_in"] * (1 + math.log(n, log.fanout))
    assert len(m["runs"]) <= 3 * (1 + math.log(n, log.fanout))
    # Only what the last versions name is kept.
    on_disk = {p.rsplit("run=", 1)[1] for p in glob.glob(f"{log.root}/runs/*")}
    named = {e["name"] for p in glob.glob(f"{log.root}/manifest/*.json") for e in json.load(open(p))["runs"]}
    assert on_disk <= named and len(glob.glob(f"{log.root}/manifest/*.json")) <= delta_log.KEEP_VERSIONS


def test_empty_log_and_empty_batch(spark):
    log = DeltaLog(spark, scratch_path(spark, "t-log"))
    assert log.read().count() == 0 and log.for_hours(spark.createDataFrame([], "date string, hour string")).count() == 0
    assert log.append(spark.createDataFrame([], SCHEMA), "s", 0)
    assert log.read().count() == 0 and not glob.glob(f"{log.root}/runs/*")
    assert not log.append(batch(spark, 1), "s", 0)                      # its id is taken
    assert log.append(batch(spark, 1), "other", 0)                      # another source numbers its own batches
    assert rows(log.read()) == expected([1])


def test_days_and_hours_are_pruned(spark):
    log = DeltaLog(spark, scratch_path(spark, "t-log"), fanout=100)
    for k in range(6):
        log.append(batch(spark, k), "s", k, compact=False)
    for path in glob.glob(f"{log.root}/runs/*/date=*/*.parquet"):       # reading any other day would fail
        if "date=2024-01-03" not in path:
            with open(path, "w") as f:
                f.write("not parquet")
    assert rows(log.read(("2024-01-03", "2024-01-03"))) == expected([2])
    hours = spark.createDataFrame([("2024-01-03", "02"), ("2024-01-03", "02"), ("2024-01-03", "99")], "date string, hour string")
    assert rows(log.for_hours(hours)) == [("2024-01-03", "02", "t2", 3)]


@pytest.mark.parametrize("step", ["_write_run", "_commit", "compact", "vacuum"])
@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("at", [0, 1])
def test_crash_at_any_step_then_replay(spark, monkeypatch, step, after, at):
    """A crash before or after the n-th call of each step of the append that folds, then the same batch again."""
    root = scratch_path(spark, "t-log")
    log = DeltaLog(spark, root, fanout=2)
    for k in range(3):
        log.append(batch(spark, k), "s", k)
    real, calls = getattr(DeltaLog, step), []

    def crash(self, *args, **kwargs):
        calls.append(step)
        if len(calls) == at + 1 and not after:
            raise RuntimeError("crash")
        done = real(self, *args, **kwargs)
        if len(calls) == at + 1:
            raise RuntimeError("crash")
        return done
    monkeypatch.setattr(DeltaLog, step, crash)
    try:
        log.append(batch(spark, 3), "s", 3)
    except RuntimeError:
        pass
    monkeypatch.setattr(DeltaLog, step, real)
    log = DeltaLog(spark, root, fanout=2)
    assert rows(log.read()) in (expected(range(3)), expected(range(4)))  # never half a batch
    log.append(batch(spark, 3), "s", 3)
    log.append(batch(spark, 4), "s", 4)
    assert rows(log.read()) == expected(range(5))
    named = {e["name"] for e in log.manifest()[1]["runs"]}
    assert all(glob.glob(f"{root}/runs/run={n}/_SUCCESS") for n in named)


def test_a_second_writer_is_refused(spark):
    root = scratch_path(spark, "t-log")
    one, other = DeltaLog(spark, root), DeltaLog(spark, root)
    version, content = one.manifest()
    other.append(batch(spark, 0), "s", 0)
    with pytest.raises(RuntimeError, match="another writer"):
        one._commit(version + 1, content)
