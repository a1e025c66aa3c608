"""Records of landed files that cannot be used: kept with their reason, and counted.

A checked read adds three columns to its rows: why a record is refused (NULL for
a good one), the record as it stands in the file, and the file. ``parted`` turns
that into good rows and a table of rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.session import materialise

REASON, RECORD, FILE = "_motivo", "_registro", "_arquivo"
# Spark's own column for text that it cannot parse.
CORRUPT = "_corrompido"
OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
# Reasons.
MALFORMED = "malformado"
NO_FIELDS = "sem_campos"
NO_DATE = "sem_data"
NO_RECORDS = "sem_registros"


def marked(rows: DataFrame, **reasons: Column) -> DataFrame:
    """``rows`` of a permissive read with the columns of a checked one; the first reason that holds counts."""
    found = F.when(F.col(CORRUPT).isNotNull(), MALFORMED)
    for reason, holds in reasons.items():
        found = found.when(holds, reason)
    record = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*[c for c in rows.columns if c != CORRUPT])))
    checked = rows.withColumns({REASON: found, FILE: F.col("_metadata.file_path"), RECORD: record})
    return checked.withColumn(RECORD, F.when(F.col(REASON).isNotNull(), F.col(RECORD))).drop(CORRUPT)


def parted(checked: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the rejects (fonte, arquivo, motivo, registro), of one checked read (eager: read once)."""
    parsed = materialise(checked, "parsed")
    rejects = parsed.filter(F.col(REASON).isNotNull()).select(
        F.lit(source).alias("fonte"),
        F.col(FILE).alias("arquivo"),
        F.col(REASON).alias("motivo"),
        F.col(RECORD).alias("registro"),
    )
    return parsed.filter(F.col(REASON).isNull()).drop(REASON, RECORD, FILE), rejects


def counts(rejects: DataFrame) -> DataFrame:
    """Rejects per source and reason."""
    return rejects.groupBy("fonte", "motivo").agg(
        F.count("*").alias("registros"), F.count_distinct("arquivo").alias("arquivos")
    )


def write_rejects(rejects: DataFrame, path: str) -> None:
    """Keep rejects, in folders by source and reason."""
    rejects.write.mode("append").partitionBy("fonte", "motivo").parquet(path)
