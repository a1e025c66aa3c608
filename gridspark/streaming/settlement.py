"""Sale requests as a stream, settled batch by batch in arrival order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridspark import schemas
from gridspark.operators import settlement
from gridspark.session import materialise
from gridspark.sources import layout
from gridspark.streaming import ledger

BALANCE = schemas.ddl(id="bigint", saldo="double")
# Batches between two snapshots of all balances.
SNAPSHOT_EVERY = 50

OUTCOME = schemas.ddl(
    credito_id="bigint",
    seq="int",
    tie="bigint",
    tie2="bigint",
    quantidade_kwh="double",
    valor_rs="double",
    valor_token="double",
    tx_blockchain="string",
    data_transacao="timestamp_ntz",
    status="string",
    sinal_suspeito="int",
    tipo="string",
)


def sale_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Sale requests of a folder, one JSON record per line."""
    reader = spark.readStream.schema(schemas.SALE).option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def _left(credits: DataFrame, path: str, before: int | None) -> DataFrame:
    """``credits`` with the balance that the batches before left them (eager: finds the snapshot)."""
    parts = layout.parts(credits.sparkSession, f"{path}/saldos", BALANCE)
    if before is not None:
        parts = parts.filter(F.col("parte") < before)
    newest = parts.groupBy("id").agg(F.max_by("saldo", "parte").alias("saldo"))
    return credits.join(newest, "id", "left").withColumn("saldo_kwh", F.coalesce("saldo", "saldo_kwh")).drop("saldo")


def start_settlement(
    requests: DataFrame, credits: DataFrame, path: str, checkpoint: str, snapshot_every: int = SNAPSHOT_EVERY
) -> StreamingQuery:
    """Settle new requests against what earlier batches left of the credits.

    ``credits`` is the balance before the first batch. A batch writes its outcomes and
    the balances of the credits it names; the next one reads balances only, from the
    newest snapshot of all of them on, and never an outcome.
    """

    def settle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read several times below
        try:
            named = batch.select(F.col("credito_id").alias("id")).distinct()
            left = materialise(_left(credits.join(named, "id", "left_semi"), path, batch_id), "settlement-left")
            ledger.write_batch(settlement.settle(left, batch), f"{path}/desfechos", batch_id)
        finally:
            batch.unpersist()
        mine = ledger.read_one(left.sparkSession, f"{path}/desfechos", OUTCOME, batch_id)
        after = settlement.balances(left, mine).select("id", F.col("saldo_kwh").alias("saldo"))
        layout.write_part(after, f"{path}/saldos", batch_id)
        if batch_id % snapshot_every == snapshot_every - 1:
            parts = layout.parts(left.sparkSession, f"{path}/saldos", BALANCE).filter(F.col("parte") <= batch_id)
            newest = parts.groupBy("id").agg(F.max_by("saldo", "parte").alias("saldo"))
            layout.write_snapshot(materialise(newest, "settlement-balances"), f"{path}/saldos", batch_id)

    return (
        requests.writeStream.foreachBatch(settle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def left_balances(credits: DataFrame, path: str) -> DataFrame:
    """``credits`` with the balances after all batches so far."""
    return _left(credits, path, None)


def outcomes(spark: SparkSession, path: str) -> DataFrame:
    """All settled requests so far."""
    return ledger.read_all(spark, f"{path}/desfechos", OUTCOME)
