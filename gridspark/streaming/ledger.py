"""Append-only tables written by ``foreachBatch``.

A micro-batch may run again after a failure. Each one overwrites the folder of
its own batch id and reads only folders of earlier batches, so a replay gives
the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.sources.readers import stored

BATCH = "batch_id"


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_one(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """Rows of one batch."""
    table = stored(spark, path, f"{schema}, `{BATCH}` bigint")
    return table.filter(F.col(BATCH) == batch_id).drop(BATCH)


def read_all(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return stored(spark, path, f"{schema}, `{BATCH}` bigint").drop(BATCH)
