"""How stored tables lie in folders: clustered writes, pruning, compaction, a log of loads."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridspark.operators.rowsets import keep_last
from gridspark.schemas import LOADS
from gridspark.session import materialise
from gridspark.sources.readers import stored

# Readers of a table skip folders whose name begins with a line.
LOG = "_cargas"
# Folder column of tables kept by key.
BUCKET = "balde"
# Files below this size are joined by ``compact``.
SMALL_FILE = 32 << 20
# Rows of a folder that one task writes.
SLOT_ROWS = 500_000


def clustered(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt by their folder: about a file a folder, large folders split, small ones in one task."""
    return rows.hint("rebalance", *columns)


def folders(rows: DataFrame, column: str) -> list:
    """The folders that ``rows`` name, NULL among them (eager). Callers bound their number."""
    named = rows.select(F.col(column).cast("string")).distinct().toLocalIterator()
    return literals(rows, column, [r[0] for r in named])


def literals(rows: DataFrame, column: str, names: Iterable[str | None]) -> list:
    """Folder names as literals of the column's type."""
    kind = rows.schema[column].dataType
    return [None if name is None else F.lit(name).cast(kind) for name in names]


def folder_sizes(rows: DataFrame, column: str) -> dict[str | None, int]:
    """The folders that ``rows`` name, NULL among them, and the rows of each (eager). Callers bound their number."""
    counts = rows.groupBy(F.col(column).cast("string").alias("folder")).agg(F.count("*").alias("n"))
    return {r["folder"]: r["n"] for r in counts.toLocalIterator()}


def slot(column: str, key: str, sizes: dict[str | None, int]) -> Column:
    """Number of a row's part of its folder, by its key: small folders have one part, large ones several."""
    parts = {name: -(-n // SLOT_ROWS) for name, n in sizes.items()}
    several = [c for name, n in parts.items() if name is not None and n > 1 for c in (F.lit(name), F.lit(n))]
    of_named = F.create_map(*several)[F.col(column).cast("string")] if several else F.lit(None).cast("int")
    of_null = F.when(F.col(column).isNull(), max(1, parts.get(None, 1)))
    return F.pmod(F.xxhash64(key), F.coalesce(of_null, of_named, F.lit(1)))


def among(column: str, values: list) -> Column:
    """Whether a folder is one of ``values``, as literals: other folders are not even listed."""
    some = F.col(column).isin([v for v in values if v is not None])
    return some | F.col(column).isNull() if any(v is None for v in values) else some


def replace_folders(rows: DataFrame, path: str, column: str) -> None:
    """Overwrite the folders that ``rows`` name and no other."""
    clustered(rows, column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        column
    ).parquet(path)


@dataclass
class Changes:
    """What an upsert did: rows taken out, rows put in, folders written anew."""

    removed: DataFrame
    added: DataFrame
    folders: int


def upsert(incoming: DataFrame, path: str, key: str, order: list[str], buckets: int) -> Changes:
    """Replace stored rows by incoming ones of equal ``key``, in folders by its hash (eager).

    Only the folders that the batch names are read and written anew; a table keeps
    the number of ``buckets`` it began with. ``order`` names the bookkeeping columns
    of ``incoming`` that rank versions; they are not stored. Run again after a
    loss, the same batch gives the same table.
    """
    spark = incoming.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    last = keep_last(incoming.withColumn(BUCKET, bucket), [key], order).drop(*order)
    batch = materialise(last, "upsert-batch")
    touched = folders(batch, BUCKET)
    old = stored(spark, path, batch.schema)
    if not touched:
        return Changes(old.limit(0), batch, 0)
    old = materialise(old.filter(among(BUCKET, touched)), "upsert-before")
    keys = batch.select(F.col(key).alias("__key"))
    same = F.col(key).eqNullSafe(F.col("__key"))
    kept = old.join(keys, same, "left_anti")
    replace_folders(kept.unionByName(batch), path, BUCKET)
    return Changes(old.join(keys, same, "left_semi"), batch, len(touched))


def write_part(rows: DataFrame, path: str, number: int) -> None:
    """Part ``number`` of a table that is the sum of its parts; writing it again replaces it."""
    rows.write.mode("overwrite").parquet(f"{path}/partes/parte={number}")


def write_snapshot(rows: DataFrame, path: str, number: int) -> None:
    """All parts up to ``number`` in one."""
    rows.write.mode("overwrite").parquet(f"{path}/somas/parte={number}")


def parts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The newest snapshot and the parts after it, with their number (eager: finds the snapshot)."""
    schema = f"{schema}, `parte` bigint"
    sums, later = stored(spark, f"{path}/somas", schema), stored(spark, f"{path}/partes", schema)
    newest = sums.agg(F.max("parte")).first()[0]
    if newest is None:
        return later
    return later.filter(F.col("parte") > newest).unionByName(sums.filter(F.col("parte") == newest))


def compact(spark: SparkSession, path: str, schema: str | StructType, column: str, small: int = SMALL_FILE) -> int:
    """Join the files of folders that hold several small ones; returns the folders rewritten.

    The rows are copied to the scratch area first, so a job lost half way can run again.
    """
    table = stored(spark, path, schema)
    files = table.select(column, "_metadata.file_path", "_metadata.file_size").distinct()
    crowded = files.groupBy(column).agg(F.count("*").alias("files"), F.avg("file_size").alias("size"))
    names = folders(crowded.filter((F.col("files") > 1) & (F.col("size") < small)), column)
    if names:
        replace_folders(materialise(table.filter(among(column, names)), "compact"), path, column)
    return len(names)


def loads(spark: SparkSession, path: str) -> DataFrame:
    """One row per load of a table: rows attempted and inserted, last row id, time."""
    rows = stored(spark, f"{path}/{LOG}", LOADS)
    return rows.groupBy("carga", "recurso", "ingested_at").agg(
        F.max("tentados").alias("tentados"), F.max("inseridos").alias("inseridos"), F.max("ultimo_id").alias("ultimo_id")
    )


def log_load(
    spark: SparkSession, path: str, load: str, resource: str, at: str, attempted: int, last_id: int, inserted: int | None
) -> None:
    """Note a load: before its rows are written, to keep its ids, and with their number afterwards."""
    row = spark.createDataFrame(
        [(load, resource, attempted, inserted, last_id)],
        "carga string, recurso string, tentados bigint, inseridos bigint, ultimo_id bigint",
    ).withColumn("ingested_at", F.lit(at).cast("timestamp_ntz"))
    row.coalesce(1).write.mode("append").parquet(f"{path}/{LOG}")


def new_load() -> str:
    return uuid.uuid4().hex


def last_id(spark: SparkSession, path: str, schema: str, column: str) -> int:
    """The last row id given out: of the log, or of a table that has none (eager)."""
    noted = loads(spark, path).agg(F.max("ultimo_id")).first()[0]
    if noted is None:
        noted = stored(spark, path, schema).agg(F.max(column)).first()[0]
    return noted or 0
