"""Device measurements as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridspark import schemas
from gridspark.operators import credits
from gridspark.operators.measurements import (
    adapt_generic,
    adapt_vendor,
    distinct_measurements,
    measurement_hash,
    usage_windows,
    with_surplus,
)
from gridspark.sources.readers import stored
from gridspark.streaming import ledger, state

EARNED = schemas.ddl(cliente_id="bigint", excedente_kwh="double", medicoes="bigint")
ACCEPTED = schemas.ddl(
    cliente_id="bigint", excedente_kwh="double", hash="string", batch_id="bigint", dia="date"
)
BALANCE = schemas.ddl(cliente_id="bigint", excedente_kwh="double", medicoes="bigint")
# Batches of balance updates between two snapshots of all balances.
SNAPSHOT_EVERY = 50
# Day under which measurements without a time are kept.
NO_DAY = "1900-01-01"


def payload_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Messages of a folder, one JSON text per line."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)


def measurement_stream(
    spark: SparkSession,
    generic: str | None = None,
    vendor: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """Measurements of the generic and the vendor message folders together."""
    parts = []
    if generic:
        parts.append(adapt_generic(payload_stream(spark, generic, files_per_batch)))
    if vendor:
        parts.append(adapt_vendor(payload_stream(spark, vendor, files_per_batch)))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def watermarked(measurements: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Event time as TIMESTAMP with a watermark (zone-less times cannot carry one)."""
    return measurements.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


def window_stream(
    measurements: DataFrame, width: str = "1 hour", delay: str = "1 hour"
) -> DataFrame:
    """Closed usage windows per client; later rows than the delay are dropped."""
    return usage_windows(watermarked(measurements, delay), width)


def start_crediting(measurements: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Credit each measurement once, however late it comes or is repeated.

    Accepted measurements are kept under ``path`` by batch and day; a batch is
    compared with the days it names only, so its work does not grow with the
    history. What it earned per client is written beside them.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        spark, accepted = batch.sparkSession, f"{path}/accepted"
        day = F.coalesce(F.col("ts").cast("date"), F.lit(NO_DAY).cast("date"))
        batch = batch.withColumn("dia", day).persist()
        try:
            # calendar days, not rows
            named = batch.select(F.col("dia").cast("string")).distinct().toLocalIterator()
            days = [F.lit(r["dia"]).cast("date") for r in named]
            known = stored(spark, accepted, ACCEPTED).filter(
                (F.col("batch_id") < batch_id) & F.col("dia").isin(days)
            )
            fresh = with_surplus(distinct_measurements(batch)).join(
                known.select("dia", "hash"), ["dia", "hash"], "left_anti"
            )
            fresh.select("cliente_id", "excedente_kwh", "hash", "dia").write.mode("overwrite").option(
                "partitionOverwriteMode", "static"
            ).partitionBy("dia").parquet(f"{accepted}/batch_id={batch_id}")
        finally:
            batch.unpersist()
        mine = stored(spark, accepted, ACCEPTED).filter(F.col("batch_id") == batch_id)
        ledger.write_batch(_earned(mine, F.count("*")), f"{path}/earned", batch_id)

    return (
        measurements.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _earned(rows: DataFrame, count: Column) -> DataFrame:
    return rows.groupBy("cliente_id").agg(
        F.sum("excedente_kwh").alias("excedente_kwh"), count.alias("medicoes")
    )


def running_balance(spark: SparkSession, path: str) -> DataFrame:
    """Σ surplus and number of measurements per client over all batches credited so far."""
    return _earned(ledger.read_all(spark, f"{path}/earned", EARNED), F.sum("medicoes"))


def credited(table: DataFrame, path: str, as_of: str) -> DataFrame:
    """The credit table with all surplus written so far."""
    earned = running_balance(table.sparkSession, path).filter(F.col("excedente_kwh") > 0)
    return credits.apply_surplus(table, earned.drop("medicoes"), as_of)


def balance_stream(measurements: DataFrame) -> DataFrame:
    """Σ surplus and number of measurements per client, as state that grows with the stream.

    A measurement counts once, whenever it is repeated; of messages that differ
    beyond the identity of a measurement the one met first counts.
    """
    once = measurements.withColumn("hash", measurement_hash()).dropDuplicates(["hash"])
    return with_surplus(once).groupBy("cliente_id").agg(
        F.sum("excedente_kwh").alias("excedente_kwh"), F.count("*").alias("medicoes")
    )


def start_balance(
    measurements: DataFrame, path: str, checkpoint: str, snapshot_every: int = SNAPSHOT_EVERY
) -> StreamingQuery:
    """Keep the balance of every client by a running sum; only clients of a batch are written.

    A batch overwrites the folder of its own id with the balances it changed, so a
    repeated batch gives the same table. Every ``snapshot_every`` batches all balances
    are written together, and readers start from the newest of these.
    """
    spark = measurements.sparkSession

    def update(batch: DataFrame, batch_id: int) -> None:
        ledger.write_batch(batch, f"{path}/updates", batch_id)
        if batch_id % snapshot_every == snapshot_every - 1:
            ledger.write_batch(balances(batch.sparkSession, path, batch_id), f"{path}/snapshots", batch_id)

    with state.on_disk(spark):
        return (
            balance_stream(measurements)
            .writeStream.foreachBatch(update)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def balances(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """Balance of every client after the batch ``upto``, the last one by default (eager: finds the snapshot)."""
    schema = f"{BALANCE}, `{ledger.BATCH}` bigint"
    snapshots, updates = (stored(spark, f"{path}/{part}", schema) for part in ("snapshots", "updates"))
    batch = F.col(ledger.BATCH)
    if upto is not None:
        # A snapshot of the batch itself is what a repeated batch is about to write.
        snapshots, updates = snapshots.filter(batch < upto), updates.filter(batch <= upto)
    newest = snapshots.agg(F.max(batch)).first()[0]
    since = updates if newest is None else updates.filter(batch > newest)
    rows = since if newest is None else since.unionByName(snapshots.filter(batch == newest))
    return rows.groupBy("cliente_id").agg(F.max_by(F.struct("excedente_kwh", "medicoes"), batch).alias("b")).select(
        "cliente_id", "b.*"
    )
