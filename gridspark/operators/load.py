"""Grid load: parsing of the stored records, curves, coverage and paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.operators.rowsets import first_rows
from gridspark import schemas
from gridspark.functions.parsing import first_filled, first_truthy, json_columns

SLOT_SECONDS = 1800
EPOCH = "1970-01-01 00:00:00"


def _number(name: str) -> Column:
    return F.col(name).try_cast("double")


def reference_time() -> Column:
    """Reference time of a load record: UTC field first, then the local ones."""
    names = ["din_referenciautc", "din_referencia", "dat_referencia"]
    text = first_filled(*[F.col(n) for n in names])
    return text.try_cast("timestamp_ntz")


def load_points(load: DataFrame, *keep: str) -> DataFrame:
    """Load rows with the JSON parsed once: time and value; ``keep`` names more columns to carry."""
    keys = ["id", "tipo", "area", "created_at", *keep]
    value = first_truthy(_number("val_cargaglobal"), _number("valor"), _number("val_carga"))
    return load.select(*keys, json_columns("data_json", schemas.LOAD_RECORD)).select(
        *keys,
        reference_time().alias("ts"),
        _number("val_cargaglobal").alias("carga_global"),
        value.alias("val"),
    )


def official_points(records: DataFrame) -> DataFrame:
    """Official load records (as text fields) as area, time and value."""
    value = first_truthy(_number("val_cargaglobal"), _number("val_carga"))
    return records.select("area", reference_time().alias("ts"), value.alias("val"))


def load_page(
    load: DataFrame, area: str | None = None, limit: int | None = 100, offset: int = 0
) -> DataFrame:
    """Newest stored load rows, optionally of one area; all of them without a limit."""
    rows = load.filter(F.col("area") == area.upper()) if area else load
    newest = rows.orderBy(F.desc("created_at"), F.desc("id")).offset(offset)
    return first_rows(newest, limit).select("id", "area", "tipo", "data_json")


def load_series(points: DataFrame, area: str, start: str, end: str) -> DataFrame:
    """Load curve of one area, start included, end not.

    Of a stored table only the folders of those days are read.
    """
    ts = F.col("ts")
    if "dia" in points.columns:
        points = points.filter(F.col("dia").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return points.filter(
        (F.col("area") == area)
        & (ts >= F.lit(start).cast("timestamp_ntz"))
        & (ts < F.lit(end).cast("timestamp_ntz"))
    ).select("id", F.col("ts").alias("data"), F.col("carga_global").alias("carga"))


def load_daily(
    points: DataFrame, as_of: str, days: int = 30, area: str | None = None
) -> DataFrame:
    """Σ load per reference date over the ``days`` up to ``as_of``."""
    day = F.col("ts").cast("date")
    last = F.lit(as_of).cast("date")
    rows = points.filter(day.between(F.date_sub(last, days), last))
    if area:
        rows = rows.filter(F.col("area") == area)
    return rows.groupBy(day.alias("dat_referencia")).agg(
        F.sum("carga_global").alias("carga_total")
    )


def half_hour_slot(ts: Column) -> Column:
    """Number of half hours since 1970."""
    seconds = F.timestamp_diff("SECOND", F.lit(EPOCH).cast("timestamp_ntz"), ts)
    return F.floor(seconds / SLOT_SECONDS)


def coverage(points: DataFrame) -> DataFrame:
    """Per area: first and last time, rows, half-hour slots seen, expected and gaps.

    Rows are reduced to the distinct slots of an area before slots are compared
    with their neighbours, so the window sees time, not rows.
    """
    slots = (
        points.filter(F.col("ts").isNotNull())
        .groupBy("area", half_hour_slot(F.col("ts")).alias("slot"))
        .agg(F.count("*").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    )
    nxt = F.lead("slot").over(Window.partitionBy("area").orderBy("slot"))
    gap = F.when(F.col("nxt") > F.col("slot") + 1, F.col("nxt") - F.col("slot") - 1)
    return (
        slots.withColumn("nxt", nxt)
        .groupBy("area")
        .agg(
            F.min("lo").alias("inicio"),
            F.max("hi").alias("fim"),
            F.sum("n").alias("registros"),
            F.count("*").alias("pontos"),
            (F.max("slot") - F.min("slot") + 1).alias("pontos_esperados"),
            F.count(gap).alias("lacunas"),
            F.coalesce(F.max(gap), F.lit(0)).alias("maior_lacuna"),
        )
    )
