"""Growth of the tables over time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.operators.capacity import connected_on
from gridspark.operators.rowsets import first_rows

MEASURES = [
    "mmgd_ativos",
    "mmgd_potencia_kw",
    "siga_ativos",
    "siga_potencia_kw",
    "ons_carga_media_mw",
]


def _dated_units(fact: DataFrame) -> DataFrame:
    return fact.select(
        connected_on(fact).alias("dia"), "potencia_instalada_kw"
    )


def _by_day(rows: DataFrame, *sums) -> DataFrame:
    return rows.groupBy("dia").agg(*sums)


def snapshots(fact: DataFrame, plants: DataFrame, points: DataFrame, days: list[str]) -> DataFrame:
    """One row for each of ``days``: units and plants with their kW, mean load, total rows.

    Units count once connected, load up to that day, plants from the day they enter operation;
    plants without a readable date count always. Every table is reduced to its dates first, and a
    date then counts for each day that is not before it.
    """
    first = F.lit("0001-01-01").cast("date")
    entered = (
        F.col("data_entrada_operacao").try_cast("date")
        if "data_entrada_operacao" in plants.columns
        else F.lit(None).cast("date")
    )
    parts = [
        _by_day(
            _dated_units(fact).filter(F.col("dia").isNotNull()),
            F.count("*").alias("mmgd"),
            F.sum("potencia_instalada_kw").alias("mmgd_kw"),
        ),
        _by_day(
            plants.withColumn("dia", F.coalesce(entered, first)),
            F.count("*").alias("siga"),
            F.sum("potencia_outorgada_kw").alias("siga_kw"),
        ),
        _by_day(
            points.withColumn("dia", F.col("ts").cast("date")).filter(F.col("dia").isNotNull()),
            F.count("*").alias("linhas"),
            F.count("carga_global").alias("medidas"),
            F.sum("carga_global").alias("carga"),
        ),
        # Days before every date still get a row.
        fact.sparkSession.range(1).select(first.alias("dia")),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    marks = F.array(*[F.lit(day).cast("date") for day in days])
    reached = stacked.select("*", F.explode(F.filter(marks, lambda day: day >= F.col("dia"))).alias("data"))

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0))

    return reached.groupBy("data").agg(
        total("mmgd").alias("mmgd_ativos"),
        F.coalesce(F.sum("mmgd_kw"), F.lit(0.0)).alias("mmgd_potencia_kw"),
        total("siga").alias("siga_ativos"),
        F.coalesce(F.sum("siga_kw"), F.lit(0.0)).alias("siga_potencia_kw"),
        F.when(total("medidas") > 0, F.sum("carga") / total("medidas")).alias("ons_carga_media_mw"),
        (total("mmgd") + total("siga") + total("linhas")).alias("total_registros"),
    )


def snapshot(fact: DataFrame, plants: DataFrame, points: DataFrame, as_of: str) -> DataFrame:
    """The one row of ``snapshots`` for ``as_of``."""
    return snapshots(fact, plants, points, [as_of])


def registry_history(fact: DataFrame) -> DataFrame:
    """Units and kW connected up to each month end.

    The running total is taken over one row per month.
    """
    monthly = (
        _dated_units(fact)
        .filter(F.col("dia").isNotNull())
        .groupBy(F.last_day("dia").alias("data"))
        .agg(F.count("*").alias("n"), F.sum("potencia_instalada_kw").alias("kw"))
    )
    upto = Window.orderBy("data").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.select(
        "data",
        F.sum("n").over(upto).alias("mmgd_ativos"),
        F.sum("kw").over(upto).alias("mmgd_potencia_kw"),
    )


def deltas(log: DataFrame) -> DataFrame:
    """Snapshots oldest first with the change since the one before."""
    order = Window.orderBy("data")
    return log.withColumns(
        {f"delta_{c}": F.col(c) - F.lag(c).over(order) for c in MEASURES if c in log.columns}
    ).orderBy("data")


def recent(log: DataFrame, limit: int | None = 30) -> DataFrame:
    """Newest snapshots first."""
    return first_rows(log.orderBy(F.desc("data")), limit)
