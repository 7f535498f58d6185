"""Log-structured archive of hashtag counts: a batch appends a run, compaction folds runs by size.

An upsert that overwrites every hour a batch touches writes an hour again with each batch that
still adds to it.  Here a batch writes its own counts only, as one immutable *run* (Parquet, a
folder per date, rows ordered by hour so that file statistics prune hours); readers sum the live
runs.  Runs of about one size are folded into one when ``fanout`` of them have gathered, so a row
is written once per size class: O(log) times in all.

The live runs are listed in a small versioned manifest.  A batch counts from the moment its
manifest version appears (an atomic rename), and a manifest remembers the last batch id of each
source: a batch that is run again after a crash at any point is either done, or written again
under the same run name.  What no recent version names is deleted.  One writer at a time is
assumed; readers may run beside it.
"""

from __future__ import annotations

import json
import math
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import hashtags
from larkspur.plans.archive import _drop, _exists, _fs

FANOUT = 4
KEEP_VERSIONS = 4                # a reader that has planned on an older version may fail
EMPTY = {"runs": [], "done": {}, "rows_in": 0, "rows_written": 0}


def _versions(spark: SparkSession, root: str) -> list[int]:
    fs, p = _fs(spark, f"{root}/manifest")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


class DeltaLog:
    """The log below one folder."""

    def __init__(self, spark: SparkSession, root: str, fanout: int = FANOUT):
        self.spark, self.root, self.fanout = spark, root.rstrip("/"), fanout

    def _path(self, version: int) -> str:
        return f"{self.root}/manifest/{version:020d}.json"

    def manifest(self) -> tuple[int, dict]:
        """(version, content) of the newest manifest; version 0 is the empty log."""
        versions = _versions(self.spark, self.root)
        return (versions[-1], json.loads(_read_text(self.spark, self._path(versions[-1])))) if versions else (0, json.loads(json.dumps(EMPTY)))

    def _commit(self, version: int, content: dict) -> None:
        """Make ``content`` the given version; from here on it counts."""
        final, temporary = self._path(version), f"{self.root}/manifest/_{version}.tmp"
        fs, p = _fs(self.spark, temporary)
        out = fs.create(p, True)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()
        if _exists(self.spark, final) or not fs.rename(p, _fs(self.spark, final)[1]):
            raise RuntimeError(f"another writer has made version {version} of {self.root}")

    def _run_path(self, name: str) -> str:
        return f"{self.root}/runs/run={name}"

    def _write_run(self, counts: DataFrame, name: str) -> dict:
        """Write a run; its manifest entry.  What a crash has left under the name is overwritten."""
        path = self._run_path(name)
        (counts.select(*hashtags.STATS_KEYS, F.col("cnt").cast("bigint").alias("cnt"))
         .hint("rebalance", "date").sortWithinPartitions("date", "hour", "hashtag")
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("date").parquet(path))
        written = self.spark.read.schema(hashtags.STATS_SCHEMA).parquet(path)                # reads no column of the files
        rows, lo, hi = written.agg(F.count(F.lit(1)), F.min("date"), F.max("date")).first()
        return {"name": name, "rows": rows, "lo": lo, "hi": hi}

    def _runs(self, entries: list[dict], dates: tuple[str, str] | None = None) -> DataFrame:
        """Rows of the runs whose dates meet ``dates``; a key may be in several."""
        met = [e for e in entries if not dates or e["lo"] is None or (e["lo"] <= dates[1] and e["hi"] >= dates[0])]
        if not met:
            return self.spark.createDataFrame([], hashtags.STATS_SCHEMA)
        rows = (self.spark.read.schema(hashtags.STATS_SCHEMA).option("basePath", f"{self.root}/runs")
                .parquet(*[self._run_path(e["name"]) for e in met]).select(*hashtags.STATS_KEYS, "cnt"))
        return rows.where(F.col("date").between(*dates)) if dates else rows

    @staticmethod
    def _summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*hashtags.STATS_KEYS).agg(F.sum("cnt").cast("bigint").alias("cnt"))

    def read(self, dates: tuple[str, str] | None = None) -> DataFrame:
        """(date, hour, hashtag, cnt) of the whole log, or of the days from ``dates[0]`` to ``dates[1]``."""
        return self._summed(self._runs(self.manifest()[1]["runs"], dates))

    def for_hours(self, hours: DataFrame) -> DataFrame:
        """Counts of the given (date, hour) rows: days and runs are pruned by the hours' date bounds."""
        lo, hi = hours.agg(F.min("date"), F.max("date")).first()
        if lo is None:
            return self.read().limit(0)
        rows = self._runs(self.manifest()[1]["runs"], (lo, hi))
        return self._summed(rows.join(hours.where(F.col("date").between(lo, hi)).distinct(), ["date", "hour"], "left_semi"))

    def append(self, counts: DataFrame, source: str, batch_id: int, compact: bool = True) -> bool:
        """Add a batch's counts as a run; False if this source's batch is already in the log.

        A source's batch ids must ascend.  An empty batch leaves no run.
        """
        version, content = self.manifest()
        if batch_id <= content["done"].get(source, -1):
            return False
        entry = self._write_run(counts, f"b{sha256(source.encode()).hexdigest()[:16]}-{batch_id}")
        content["done"][source] = batch_id
        if entry["rows"]:
            content["runs"].append(entry)
            content["rows_in"] += entry["rows"]
            content["rows_written"] += entry["rows"]
        self._commit(version + 1, content)
        if not entry["rows"]:
            _drop(self.spark, self._run_path(entry["name"]))
        if compact:
            self.compact()
        self.vacuum()
        return True

    def _size_class(self, entry: dict) -> int:
        return int(math.log(max(1, entry["rows"]), self.fanout) + 1e-9)

    def compact(self) -> int:
        """Fold runs of one size class while ``fanout`` of them are live; the number of folds.

        Can also be run by a job of its own between two batches (``append(..., compact=False)``).
        """
        folds = 0
        while True:
            version, content = self.manifest()
            classes: dict[int, list[dict]] = {}
            for e in content["runs"]:
                classes.setdefault(self._size_class(e), []).append(e)
            full = [es for _, es in sorted(classes.items()) if len(es) >= self.fanout]
            if not full:
                return folds
            names = {e["name"] for e in full[0]}
            entry = self._write_run(self._summed(self._runs(full[0])), f"c{version + 1}")
            content["runs"] = [e for e in content["runs"] if e["name"] not in names] + [entry]
            content["rows_written"] += entry["rows"]
            self._commit(version + 1, content)
            folds += 1

    def vacuum(self) -> None:
        """Delete old manifest versions, and the runs that only they name."""
        versions = _versions(self.spark, self.root)
        old, kept = versions[:-KEEP_VERSIONS], versions[-KEEP_VERSIONS:]
        if not old:
            return
        names = {v: {e["name"] for e in json.loads(_read_text(self.spark, self._path(v)))["runs"]} for v in versions}
        for name in set().union(*(names[v] for v in old)) - set().union(*(names[v] for v in kept)):
            _drop(self.spark, self._run_path(name))
        for v in old:
            _drop(self.spark, self._path(v))
