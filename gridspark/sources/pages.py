"""Pages by key over a table stored in the order it is shown in.

An offset makes a page read all before it. Here the files follow the display
order and an index names the first and last key and the rows of each; a page
starts behind the last key of the one before and reads the next files only,
however far the table has been turned over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.session import materialise

KEY = "chave"
# Readers of the table skip folders whose name begins with a line.
INDEX = "_indice"
FILE_ROWS = 1_000_000
# Rows that a task stores, in as many files as they make: what tasks tell the driver
# of themselves must not grow with the files.
TASK_ROWS = 1_000_000


def falling(value: Column) -> Column:
    """A number as part of a key, largest first and NULL last."""
    return F.struct(value.isNull().alias("none"), (-value).alias("value"))


def write_pages(rows: DataFrame, path: str, key: list[Column], file_rows: int = FILE_ROWS) -> None:
    """Store ``rows`` in the order of ``key``, whose last part must tell rows apart (eager)."""
    spark = rows.sparkSession
    keyed = materialise(rows.withColumn(KEY, F.struct(*[k.alias(f"k{i}") for i, k in enumerate(key)])), "pages")
    tasks = max(1, -(-keyed.count() // max(file_rows, TASK_ROWS)))
    ordered = keyed.repartitionByRange(tasks, KEY).sortWithinPartitions(KEY)
    ordered.write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(path)
    stored = spark.read.schema(keyed.schema).parquet(path)
    index = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(KEY).alias("first"), F.max(KEY).alias("last"), F.count("*").alias("rows")
    )
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/{INDEX}")


@dataclass
class Page:
    """Rows of a page in order, where the next one starts, and the files that were read."""

    rows: DataFrame
    after: Column | None
    files: int


def read_page(
    spark: SparkSession, path: str, limit: int, after: Column | None = None, where: Column | None = None
) -> Page:
    """The ``limit`` rows behind the key ``after``, those that meet ``where`` only (eager).

    Takes as many files as their row counts ask for and, while a filter leaves too
    few rows, twice as many at a time. The driver sees the index rows of these files.
    """
    index = spark.read.parquet(f"{path}/{INDEX}")
    schema = spark.read.parquet(path).schema
    parts, missing, read, behind = [], limit, 0, after
    while missing > 0:
        ahead = index if behind is None else index.filter(F.col("last") > behind)
        # One file more than needed at least: the first one may be used up in part.
        taken = ahead.orderBy("first").limit(2 if not parts else 2 * read).collect()
        if not taken:
            break
        known = 0
        for n, file in enumerate(taken, 1):
            known += file["rows"] if n > 1 or behind is None else 0
            if known >= missing and where is None:
                taken = taken[:n]
                break
        rows = spark.read.schema(schema).parquet(*[f["file"] for f in taken])
        if behind is not None:
            rows = rows.filter(F.col(KEY) > behind)
        if where is not None:
            rows = rows.filter(where)
        part = materialise(rows.orderBy(KEY).limit(missing), "page")
        parts.append(part)
        missing -= part.count()
        read += len(taken)
        behind = _literal(taken[-1]["last"], schema[KEY].dataType)
    if not parts:
        return Page(spark.createDataFrame([], schema).drop(KEY), after, 0)
    page = parts[0]
    for part in parts[1:]:
        page = page.unionByName(part)
    last = page.agg(F.max(KEY)).first()[0]
    following = after if last is None else _literal(last, schema[KEY].dataType)
    return Page(page.orderBy(KEY).drop(KEY), following, read)


def _literal(key, kind) -> Column:
    """A key as a constant."""
    parts = []
    for field in kind.fields:
        value = key[field.name]
        if hasattr(field.dataType, "fields"):
            parts.append((F.lit(None).cast(field.dataType) if value is None else _literal(value, field.dataType)).alias(field.name))
        else:
            parts.append(F.lit(value).cast(field.dataType).alias(field.name))
    return F.struct(*parts)
