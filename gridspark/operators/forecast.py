"""Simple forecasts of load and of capacity growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.operators.load import SLOT_SECONDS

SLOTS_PER_DAY = 86_400 // SLOT_SECONDS


def _day_slot(ts: Column) -> Column:
    return (F.hour(ts) * 2 + F.floor(F.minute(ts) / 30)).cast("int")


def forecast_load(
    points: DataFrame, as_of: str, days: int = 7, weeks: int = 4, area: str | None = None
) -> DataFrame:
    """Half-hourly load of the ``days`` from ``as_of`` on, per area.

    The mean of the same weekday and half hour over the ``weeks`` before; NULL
    where that history is empty.
    """
    start = F.lit(as_of).cast("date")
    day = F.col("ts").cast("date")
    past = points.filter(day.between(F.date_sub(start, 7 * weeks), F.date_sub(start, 1)))
    if area:
        past = past.filter(F.col("area") == area)
    seasonal = past.groupBy(
        "area", F.weekday(day).alias("wd"), _day_slot(F.col("ts")).alias("slot")
    ).agg(F.avg("carga_global").alias("carga_prevista"))
    grid = (
        seasonal.select("area")
        .distinct()
        .select("area", F.explode(F.sequence(start, F.date_add(start, days - 1))).alias("dia"))
        .select(
            "area",
            "dia",
            F.explode(F.sequence(F.lit(0), F.lit(SLOTS_PER_DAY - 1))).alias("slot"),
        )
        .withColumn("wd", F.weekday("dia"))
    )
    when = F.timestamp_add("MINUTE", F.col("slot") * 30, F.col("dia").cast("timestamp_ntz"))
    return grid.join(seasonal, ["area", "wd", "slot"], "left").select(
        "area", when.alias("data"), "carga_prevista"
    )


def month_number(month: Column) -> Column:
    """Months since January 1970 of a ``yyyy-MM`` text."""
    return (F.substring(month, 1, 4).cast("int") - 1970) * 12 + F.substring(month, 6, 2).cast("int") - 1


def forecast_capacity(monthly: DataFrame, months: int = 12) -> DataFrame:
    """Connected kW of the next ``months`` per UF: straight line, never below 0.

    ``monthly`` is the capacity series (siguf, mes, potencia_kw).
    """
    x = month_number(F.col("mes")).cast("double")
    line = monthly.groupBy("siguf").agg(
        F.regr_slope("potencia_kw", x).alias("slope"),
        F.regr_intercept("potencia_kw", x).alias("base"),
        F.max(month_number(F.col("mes"))).alias("last"),
    )
    steps = line.withColumn("m", F.explode(F.sequence(F.col("last") + 1, F.col("last") + months)))
    year = F.floor(F.col("m") / 12) + 1970
    return steps.select(
        "siguf",
        F.format_string("%04d-%02d", year, F.col("m") % 12 + 1).alias("mes"),
        # A single month has no slope and no forecast.
        F.when(
            F.col("slope").isNotNull(),
            F.greatest(F.lit(0.0), F.col("base") + F.col("slope") * F.col("m")),
        ).alias("potencia_kw"),
    )
