"""Usage windows that late measurements restate instead of being dropped.

A micro-batch adds up its own measurements per client and window and writes
them as a part of its own; a window is the sum of its parts, so a measurement is
in exactly one window however late it comes, and nothing stored is read. A window
is closed once ``delay`` has passed behind its end, by the newest measurement of
earlier batches; what comes for a closed window is also kept in a side table and
counted, and gives the window a new version. A repeated batch overwrites its parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridspark import schemas
from gridspark.operators.measurements import with_surplus
from gridspark.sources import layout

PART = schemas.ddl(
    cliente_id="bigint",
    inicio="timestamp_ntz",
    fim="timestamp_ntz",
    medicoes="bigint",
    geracao="double",
    consumo="double",
    excedente="double",
    tardias="bigint",
    versao="bigint",
)
MARK = schemas.ddl(marca="timestamp_ntz")
SUMS = ["medicoes", "geracao", "consumo", "excedente", "tardias"]
# Why a measurement is in the side table.
LATE, TIMELESS = "tardia", "sem_hora"


def _mark(spark: SparkSession, path: str, before: int | None = None):
    """The newest time of the batches so far, as a constant (eager: one row a batch)."""
    marks = layout.parts(spark, f"{path}/marcas", MARK)
    if before is not None:
        marks = marks.filter(F.col("parte") < before)
    return F.lit(marks.agg(F.max("marca").cast("string")).first()[0]).cast("timestamp_ntz")


def _closed(end: Column, delay: str, mark: Column) -> Column:
    return F.coalesce(end + F.expr(f"INTERVAL {delay}") <= mark, F.lit(False))


def start_windows(
    measurements: DataFrame, path: str, checkpoint: str, width: str = "1 hour", delay: str = "1 hour"
) -> StreamingQuery:
    """Add the measurements not seen yet to their windows, then stop."""

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = _mark(spark, path, batch_id)
        batch = batch.withColumn("ts", F.col("ts").cast("timestamp_ntz")).persist()  # read three times below
        try:
            placed = with_surplus(batch).select("*", F.window("ts", width).alias("w"))
            late = _closed(F.col("w.end"), delay, mark)
            sums = placed.groupBy("cliente_id", F.col("w.start").alias("inicio"), F.col("w.end").alias("fim")).agg(
                F.count("*").alias("medicoes"),
                F.sum("geracao_kw").alias("geracao"),
                F.sum("consumo_kw").alias("consumo"),
                F.sum("excedente_kwh").alias("excedente"),
                F.count(F.when(late, 1)).alias("tardias"),
            )
            layout.write_part(sums.withColumn("versao", F.lit(batch_id).cast("bigint")), f"{path}/janelas", batch_id)
            aside = placed.filter(late).select(*batch.columns, F.lit(LATE).alias("motivo")).unionByName(
                batch.filter("ts IS NULL").withColumn("motivo", F.lit(TIMELESS))
            )
            layout.write_part(aside, f"{path}/tardias", batch_id)
            # Last, so that a batch lost before it sees the mark of the earlier ones again.
            layout.write_part(batch.agg(F.max("ts").alias("marca")), f"{path}/marcas", batch_id)
        finally:
            batch.unpersist()

    return (
        measurements.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _summed(parts: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in SUMS]
    return parts.groupBy("cliente_id", "inicio", "fim").agg(*sums, F.max("versao").alias("versao"))


def windows(spark: SparkSession, path: str, delay: str = "1 hour", flush: bool = False) -> DataFrame:
    """Every closed window as it stands now, with the batch that last changed it; ``flush`` adds the open ones."""
    current = _summed(layout.parts(spark, f"{path}/janelas", PART))
    return current if flush else current.filter(_closed(F.col("fim"), delay, _mark(spark, path)))


def versions(spark: SparkSession, path: str) -> DataFrame:
    """Every version of every window since the last ``fold``: its sums after each batch that changed it."""
    upto = Window.partitionBy("cliente_id", "inicio", "fim").orderBy("versao")
    parts = layout.parts(spark, f"{path}/janelas", PART).drop("parte")
    return parts.withColumns({c: F.sum(c).over(upto) for c in SUMS})


def set_aside(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Late measurements and those without a time; ``schema`` is that of the measurements."""
    return layout.parts(spark, f"{path}/tardias", f"{schema}, motivo string").drop("parte")


def fold(spark: SparkSession, path: str) -> None:
    """Sum the parts up to now, so that readers start from one."""
    parts = layout.parts(spark, f"{path}/janelas", PART)
    newest = parts.agg(F.max("parte")).first()[0]
    if newest is not None:
        layout.write_snapshot(_summed(parts), f"{path}/janelas", newest)
