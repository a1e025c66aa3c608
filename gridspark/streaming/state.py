"""Settings of queries that keep state."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import SparkSession

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTINGS = {
    PROVIDER: ROCKSDB,
    # A batch saves what it put; whole states are saved now and then, beside the batches.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the state's rows for reports looks every key up once more as it is put.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@contextlib.contextmanager
def on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB: beyond memory, saved by changes.

    A query takes its settings along when it starts, so the session's own stay as they are.
    """
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
