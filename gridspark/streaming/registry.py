"""Landing folder to fact table as an incremental stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridspark import schemas
from gridspark.operators.registry import lean_fact
from gridspark.streaming import ledger, state

FACT = schemas.ddl(
    id="bigint",
    cod_empreendimento="string",
    siguf="string",
    dscfontegeracao="string",
    potencia_instalada_kw="double",
    modalidade="string",
    faixa_regulatoria="string",
    hash="string",
)


def first_arrivals(rows: DataFrame) -> DataFrame:
    """Of a stream's rows those whose hash comes for the first time, of one batch the least id.

    The state holds the first row of each hash, so what was written before is never
    read. A row is new when all its hash has brought so far carries the time of
    the current batch, which a repeated batch keeps. NULL hashes never collide.
    """
    now = F.current_timestamp()
    rest = [c for c in rows.columns if c != "id"]
    return (
        rows.withColumns({"seen": now, "alone": F.when(F.col("hash").isNull(), F.col("id"))})
        .groupBy(F.col("hash").alias("key"), "alone")
        .agg(F.min(F.struct("seen", "id", *rest)).alias("first"), F.max("seen").alias("last"))
        .filter((F.col("first.seen") == now) & (F.col("last") == now))
        .select(*[F.col(f"first.{c}").alias(c) for c in rows.columns])
    )


def start_fact_stream(
    spark: SparkSession, landing: str, fact_path: str, checkpoint: str, files_per_batch: int | None = 1000
) -> StreamingQuery:
    """Process all landing files not seen yet, then stop.

    The checkpoint remembers the files and, in RocksDB, the hashes met: a batch
    reads its own files only and writes one folder of its own.
    """
    source = spark.readStream.schema(schemas.RAW)
    if files_per_batch is not None:
        source = source.option("maxFilesPerTrigger", files_per_batch)

    def append(batch: DataFrame, batch_id: int) -> None:
        ledger.write_batch(batch, fact_path, batch_id)

    with state.on_disk(spark):
        return (
            first_arrivals(lean_fact(source.parquet(landing)))
            .writeStream.foreachBatch(append)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def read_fact(spark: SparkSession, fact_path: str) -> DataFrame:
    """The fact table the stream maintains."""
    return ledger.read_all(spark, fact_path, FACT)
