"""Session defaults and the shared scratch area of a cluster."""

from __future__ import annotations

import contextlib
import re
import tempfile
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings a job on this library wants whatever the cluster size. Partition
# counts are left to the cluster: adaptive execution coalesces or splits them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Newest or largest rows per key are cut in the map task up to this many a key.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Recording a Python call site for every Column costs more than planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


_LOCAL_ROOTS: dict[str, str] = {}
# Bytes of rows that a Python task is handed at once by jobs with small batches.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"
# Bytes of a table's files up to which joins of jobs with small broadcasts send it to every task.
# Rows of repeated values take many times their files in memory (13 were measured).
BROADCAST_SETTING, BROADCAST_BYTES = "spark.sql.autoBroadcastJoinThreshold", 1 << 20
SCRATCH_NAME = re.compile(r"[a-z0-9-]+-[0-9a-f]{32}")


def build(app: str = "gridspark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Executors can be lost, so intermediate tables must live where every node
    sees them. Only a local-mode session may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    # The setting cannot be changed in a running session, so the process remembers.
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="gridspark-")
    return _LOCAL_ROOTS[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the scratch area."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the scratch area, with the writer's ``options``, and read it back (eager).

    Cuts the lineage with a table that survives executor loss and keeps column
    pruning and filter push-down for its readers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession, older_than_hours: float) -> int:
    """Delete scratch tables whose folder was last changed before so many hours; returns how many went.

    Jobs keep their intermediate tables, as results read them lazily: choose a time
    that no result outlives. Only folders that ``scratch_path`` named are looked at.
    """
    root = scratch_root(spark)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(root)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    limit = (time.time() - older_than_hours * 3600) * 1000
    gone = 0
    for entry in files.listStatus(place) if files.exists(place) else []:
        ours = entry.isDirectory() and SCRATCH_NAME.fullmatch(entry.getPath().getName())
        if ours and entry.getModificationTime() < limit:
            files.delete(entry.getPath(), True)
            gone += 1
    return gone


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give an input that arrives in too few tasks to every core.

    A file of a single row group is read by one task however large the cluster;
    costly per-row work on it is worth a shuffle by ``key``. Inputs with enough
    splits pass through untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


@contextlib.contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_batches(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Jobs planned inside hand rows to tasks in small batches."""
    return _set(spark, BATCH_SETTING, BATCH_BYTES)


def small_broadcasts(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Joins planned inside broadcast no table of more than ``BROADCAST_BYTES``, or of what the session allows if less."""
    allowed = spark.conf.get(BROADCAST_SETTING)
    if not allowed.startswith("-"):  # a negative size allows none
        size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(allowed)
        allowed = str(min(size, BROADCAST_BYTES))
    return _set(spark, BROADCAST_SETTING, allowed)
