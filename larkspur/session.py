"""Session construction and the shared working folder.

All intermediate files (sink round trips, archives, stream checkpoints) go
under the folder named by ``spark.checkpoint.dir``.  On a cluster that is a
shared file system path set by whoever launches the job; we only set our own
(a fresh local temp folder) when the session has none, as in tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "larkspur", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings the library relies on (idempotent).

    UTC keeps date/hour derivations engine independent.  Partition overwrite
    mode is not changed here: every partitioned write sets it explicitly.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    shared_dir(spark)
    return spark


_LOCAL_BASES: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder from ``spark.checkpoint.dir``.

    Read from the session; failing that, the checkpoint dir already set on the
    SparkContext.  Only for local masters with neither (tests) a fresh temp
    folder is created and registered with ``setCheckpointDir`` (the config
    itself cannot be changed at runtime).
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = _LOCAL_BASES.get(sc.applicationId) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            # A driver-local folder is invisible to executors: refuse instead of guessing.
            raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS / object store) "
                             "for non-local masters")
        base = tempfile.mkdtemp(prefix="larkspur-ckpt-")
        _LOCAL_BASES[sc.applicationId] = base
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def _app_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/larkspur-work/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below this application's folder in the shared dir."""
    return f"{_app_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch folder (call when its results are no longer read).

    Uses the Hadoop FileSystem of the path, so it works on any shared storage.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_app_root(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)
