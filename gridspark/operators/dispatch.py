"""Day-ahead dispatch balance: generation by source, mix and demand curves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Source labels, request names and their columns.
SOURCE_COLUMNS = {
    "Hidráulica": "val_ger_hidraulica",
    "Eólica": "val_ger_eolica",
    "Solar": "val_ger_fotovoltaica",
    "Térmica": "val_ger_termica",
    "PCH": "val_ger_pch",
    "PCT": "val_ger_pct",
    "MMGD": "val_ger_mmgd",
}
SERIES_COLUMNS = {
    "hidraulica": "val_ger_hidraulica",
    "eolica": "val_ger_eolica",
    "solar": "val_ger_fotovoltaica",
    "termica": "val_ger_termica",
    "pch": "val_ger_pch",
    "pct": "val_ger_pct",
    "mmgd": "val_ger_mmgd",
}
WHOLE_GRID = "SIN"

DAY = "din_programacaodia"
LEVEL = "num_patamar"


def _between(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.filter(F.col(DAY).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def _of_subsystem(df: DataFrame, subsystem: str) -> DataFrame:
    name = subsystem.upper()
    return df if name == WHOLE_GRID else df.filter(F.col("cod_subsistema") == name)


def latest_day(df: DataFrame) -> DataFrame:
    """Rows of the newest day.

    The day comes from a scalar subquery over one column and is known before
    the second scan starts, so that scan can skip every other day.
    """
    return df.filter(F.col(DAY) == df.agg(F.max(DAY)).scalar())


def generation_by_source(dispatch: DataFrame, start: str, end: str) -> DataFrame:
    """Σ per source over [start, end]: one scan, one total row, then unpivoted."""
    totals = _between(dispatch, start, end).agg(
        *[F.sum(column).alias(label) for label, column in SOURCE_COLUMNS.items()]
    )
    return (
        totals.unpivot([], list(SOURCE_COLUMNS), "fonte", "total")
        .filter(F.col("total").isNotNull())
        .select("fonte", F.round("total", 2).alias("geracao_mw"))
    )


def generation_series(dispatch: DataFrame, source: str, start: str, end: str) -> DataFrame:
    """Daily Σ of one source; an unknown name means hydro."""
    column = SERIES_COLUMNS.get(source, SERIES_COLUMNS["hidraulica"])
    return (
        _between(dispatch, start, end)
        .groupBy(F.col(DAY).alias("data"))
        .agg(F.round(F.sum(column), 2).alias("geracao_mw"))
        .filter(F.col("geracao_mw").isNotNull())
    )


def generation_now(dispatch: DataFrame) -> DataFrame:
    """The newest dispatch row: highest level, then subsystem name, then demand."""
    return (
        latest_day(dispatch)
        .orderBy(F.desc(LEVEL), "cod_subsistema", F.desc("val_demanda"))
        .limit(1)
        .select(F.col(DAY).alias("data"), *[F.col(c).alias(n) for n, c in SOURCE_COLUMNS.items()])
    )


def _share(part: Column, whole: Column) -> Column:
    return F.round(part * 100 / F.when(whole == 0, 1.0).otherwise(whole), 1)


def mix_now(dispatch: DataFrame, subsystem: str = WHOLE_GRID) -> DataFrame:
    """Demand and generation mix at the newest day's highest level.

    Small hydro and small thermal join their big siblings; distributed
    generation stays outside the mix. No rows for an unknown subsystem.
    """
    columns = ["val_demanda", *SOURCE_COLUMNS.values()]
    levels = (
        latest_day(_of_subsystem(dispatch, subsystem))
        .groupBy(DAY, LEVEL)
        .agg(*[F.sum(c).alias(c) for c in columns])
    )

    def value(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0.0))

    parts = {
        "hidraulica": value("val_ger_hidraulica") + value("val_ger_pch"),
        "termica": value("val_ger_termica") + value("val_ger_pct"),
        "eolica": value("val_ger_eolica"),
        "solar": value("val_ger_fotovoltaica"),
    }
    whole = reduce(Column.__add__, parts.values())
    return (
        levels.select(
            F.lit(subsystem.upper()).alias("subsistema"),
            DAY,
            LEVEL,
            F.col("val_demanda").alias("demanda_mw"),
            *[part.alias(f"{name}_mw") for name, part in parts.items()],
            value("val_ger_mmgd").alias("mmgd_mw"),
            *[_share(part, whole).alias(f"{name}_pct") for name, part in parts.items()],
        )
        .orderBy(F.desc(LEVEL))
        .limit(1)
    )


def demand_history(
    dispatch: DataFrame, as_of: str, subsystem: str = WHOLE_GRID, days: int = 1
) -> DataFrame:
    """Σ demand per day and level of the ``days`` up to ``as_of``."""
    last = F.lit(as_of).cast("date")
    return (
        _of_subsystem(dispatch, subsystem)
        .filter(F.col(DAY).cast("date").between(F.date_sub(last, days), last))
        .groupBy(DAY, LEVEL)
        .agg(F.sum("val_demanda").alias("demanda_mw"))
    )
