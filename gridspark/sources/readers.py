"""Readers. All start from landed files; fetching them is not done here."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridspark import schemas
from gridspark.operators.load import reference_time
from gridspark.session import materialise
from gridspark.sources import rejects

# Load areas and record tags.
AREAS = ["S", "N", "NE", "SIN"]
VERIFIED = "verificada"
PLANNED = "programada"


def registry_snapshot(
    spark: SparkSession, path: str, max_records: int | None = None, checked: bool = False
) -> DataFrame:
    """Distributed-generation registry: ``;``-separated Latin-1 CSV, all text.

    Land the extracted CSV: a ZIP cannot be split over tasks. A checked read
    refuses lines with another number of fields than the header.
    """
    form = {"sep": ";", "header": True, "encoding": "ISO-8859-1"}
    rows = spark.read.csv(path, inferSchema=False, **form)
    if checked:
        schema = ", ".join(f"`{name}` string" for name in [*rows.columns, rejects.CORRUPT])
        rows = rejects.marked(spark.read.schema(schema).options(**rejects.OPTIONS).csv(path, **form))
    return rows if max_records is None else rows.limit(max_records)


def field_list(df: DataFrame) -> list[dict[str, str]]:
    """Name and type of every column; snapshots are all text."""
    names = {"string": "text"}
    return [{"id": name, "type": names.get(kind, kind)} for name, kind in df.dtypes]


def plant_pages(spark: SparkSession, path: str, checked: bool = False) -> DataFrame:
    """Landed result pages of the plant registry, one row per page.

    A checked read refuses pages that are no JSON or hold no list of records.
    """
    page = (
        f"result struct<total: bigint, records: array<struct<"
        f"{schemas.PLANT_RECORD.replace('` ', '`: ')}>>>"
    )
    if not checked:
        return spark.read.schema(page).json(path, multiLine=True)
    pages = spark.read.schema(f"{page}, `{rejects.CORRUPT}` string").options(**rejects.OPTIONS).json(path, multiLine=True)
    return rejects.marked(pages, **{rejects.NO_RECORDS: F.col("result.records").isNull()})


def plant_records(pages: DataFrame) -> DataFrame:
    """The records of all pages."""
    return pages.select(F.inline("result.records"))


def page_completeness(pages: DataFrame) -> DataFrame:
    """One row: records announced, records landed and whether they agree."""
    return pages.agg(
        F.max("result.total").alias("anunciados"),
        F.sum(F.size("result.records")).cast("bigint").alias("recebidos"),
    ).withColumn("completo", F.col("anunciados") == F.col("recebidos"))


def check_areas(areas: list[str]) -> list[str]:
    """The areas themselves; an unknown one raises before anything is read."""
    unknown = [a for a in areas if a not in AREAS]
    if unknown:
        raise ValueError(f"unknown area {unknown}; known: {AREAS}")
    return areas


def load_records(
    spark: SparkSession,
    path: str,
    start: str,
    end: str,
    areas: list[str] | None = None,
    kind: str = VERIFIED,
    lines: bool = False,
    checked: bool = False,
) -> DataFrame:
    """Landed load records of some areas whose reference date lies in [start, end].

    Files hold a JSON array each, or one record per line when ``lines``. An
    answer that is no list of records gives no rows. The area asked for is the
    folder a file was landed in (``S`` or ``area=S``), else the record's own. Rows
    are tagged with ``_fonte`` and ``_area``. A checked read also returns, whatever
    the area and dates, records that are no JSON, have none of the fields or no date.
    """
    wanted = check_areas(areas or AREAS)
    schema = f"{schemas.LOAD_RECORD}, `{rejects.CORRUPT}` string" if checked else schemas.LOAD_RECORD
    records = spark.read.schema(schema).options(**rejects.OPTIONS if checked else {}).json(path, multiLine=not lines)
    day = reference_time().cast("date")
    inside = day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    folder = F.regexp_extract("_metadata.file_path", rf"/(?:area=)?({'|'.join(AREAS)})/[^/]+$", 1)
    area = F.when(folder != "", folder).otherwise(F.col("cod_areacarga"))
    if checked:
        fields = [part.split("`")[1] for part in schemas.LOAD_RECORD.split(", ")]
        reasons = {
            rejects.NO_FIELDS: F.coalesce(*fields).isNull(),
            rejects.NO_DATE: reference_time().isNull(),
        }
        tagged = rejects.marked(records, **reasons).withColumns({"_fonte": F.lit(kind), "_area": area})
        good = F.col("_area").isin(wanted) & inside
        return tagged.filter(F.col(rejects.REASON).isNotNull() | good).drop("area")
    tagged = records.withColumns({"_fonte": F.lit(kind), "_area": area})
    return tagged.filter(F.col("_area").isin(wanted) & inside).drop("area")


def recent_load(
    spark: SparkSession, path: str, today: str, days: int = 1, lines: bool = False
) -> DataFrame:
    """Verified load of every area over the ``days`` up to ``today``."""
    bounds = spark.range(1).select(F.date_sub(F.lit(today).cast("date"), days)).first()
    return load_records(spark, path, str(bounds[0]), today, lines=lines)


def _headers(lines: DataFrame) -> DataFrame:
    """First line of each file, found where the files are read; no task holds its lines."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            files = pc.run_end_encode(batch.column("file"))
            for file, begin in zip(files.values.to_pylist(), [0, *files.run_ends.to_pylist()]):
                if file != last:
                    yield batch.slice(begin, 1)
                last = file

    starts = lines.filter("start = 0").select("file", F.col("value").alias("header"))
    return starts.mapInArrow(first, "file string, header string").withColumn(
        "header", F.regexp_replace("header", "^\ufeff", "")
    )


def _names(header: str) -> list[str]:
    return [name.strip().strip('"') for name in header.split(";")]


def _by_header(header: str) -> Column:
    """A line of a file with this header as texts, NULL for any other line."""
    text = ", ".join(f"`{name}` string" for name in [*_names(header), rejects.CORRUPT])
    return F.when(F.col("header") == header, F.from_csv("value", F.lit(text), {"sep": ";", **rejects.OPTIONS}))


def _json_hash(row: Column, header: str) -> Column:
    """The row hash over all columns of a file with this header."""
    body = F.to_json(F.struct(*[row[n].alias(n) for n in sorted(_names(header))]), {"ignoreNullFields": "false"})
    return F.when(F.col("header") == header, F.sha2(body, 256))


def dispatch_files(spark: SparkSession, path: str, checked: bool = False) -> DataFrame:
    """Dispatch CSVs of a folder, columns taken by name from each file's own header.

    The tasks find the header lines, and the driver sees the different ones only
    (eager). Adds the file name and the row hash over all columns of the file. A
    checked read refuses lines with another number of fields than their header.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("fonte_arquivo"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    fields = [part.strip("`").split("` ") for part in schemas.DISPATCH_FILE.split(", ")]
    headers = materialise(_headers(lines), "headers")
    kinds = [r["header"] for r in headers.select("header").distinct().collect() if r["header"]]
    if not kinds:
        none = f"{schemas.DISPATCH_FILE}, hash string, fonte_arquivo string"
        if checked:
            none += "".join(f", `{c}` string" for c in (rejects.REASON, rejects.FILE, rejects.RECORD))
        return spark.createDataFrame([], none)
    body = lines.join(headers, "file").filter(
        (F.trim("value") != "") & ~F.col("value").isin(F.col("header"), F.concat(F.lit("\ufeff"), F.col("header")))
    )
    # A generator parses each line once, however many fields are taken; a field or hash that nobody takes is not made.
    kinds = {f"linha_{k}": header for k, header in enumerate(kinds)}
    parsed = body.select(
        "value", "file", "fonte_arquivo", "header", F.inline(F.array(F.struct(*[_by_header(h).alias(k) for k, h in kinds.items()])))
    )

    def of_any(name: str) -> Column:
        held = [F.col(k)[name] for k, h in kinds.items() if name in (*_names(h), rejects.CORRUPT)]
        return F.coalesce(*held, F.lit(None).cast("string"))

    rows = parsed.select(
        *[of_any(name).try_cast(kind).alias(name) for name, kind in fields],
        F.coalesce(*[_json_hash(F.col(k), h) for k, h in kinds.items()]).alias("hash"),
        "fonte_arquivo",
        of_any(rejects.CORRUPT).alias(rejects.CORRUPT),
        "file",
        "value",
    )
    names = [*[name for name, _ in fields], "hash", "fonte_arquivo"]
    if not checked:
        return rows.select(names)
    bad = F.col(rejects.CORRUPT).isNotNull()
    return rows.select(
        *names,
        F.when(bad, rejects.MALFORMED).alias(rejects.REASON),
        F.col("file").alias(rejects.FILE),
        F.when(bad, F.col("value")).alias(rejects.RECORD),
    )


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """A landed catalogue answer; raises when it reports a failure (eager, one row)."""
    answer = spark.read.schema(schemas.CATALOGUE).json(path, multiLine=True)
    if not answer.filter(~F.coalesce("success", F.lit(False))).isEmpty():
        raise RuntimeError(f"catalogue answer reports a failure: {path}")
    return answer


def resources(answer: DataFrame) -> DataFrame:
    """Resources of a catalogue answer with their position."""
    return answer.select(F.posexplode("result.resources").alias("pos", "r")).select("pos", "r.*")


def csv_resources(answer: DataFrame) -> DataFrame:
    return resources(answer).filter(F.col("format") == "CSV")


def _first(df: DataFrame) -> DataFrame:
    return df.agg(F.min_by("url", "pos").alias("url")).filter(F.col("url").isNotNull())


def zip_by_name(answer: DataFrame) -> DataFrame:
    """URL of the first resource named ``*.zip``; no row without one."""
    return _first(resources(answer).filter(F.lower("name").endswith(".zip")))


def zip_by_format(answer: DataFrame) -> DataFrame:
    """URL of the first resource of format ZIP that has one."""
    return _first(
        resources(answer).filter((F.upper("format") == "ZIP") & (F.col("url") != ""))
    )


def stored(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A stored parquet table, empty when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def landed(spark: SparkSession, path: str) -> DataFrame:
    """The landing table of the registry without its folder column."""
    table = stored(spark, path, schemas.RAW)
    return table.select(*[name.strip("`") for name, _ in (part.split("` ") for part in schemas.RAW.split(", "))])


def stored_fact(spark: SparkSession, path: str, schema: StructType, ufs: list[str] | None = None) -> DataFrame:
    """A stored fact table without its folder column; with ``ufs`` only their folders are read.

    The empty text among ``ufs`` stands for units without a UF.
    """
    rows = spark.read.schema(schema).parquet(path)
    if ufs is not None:
        rows = rows.filter(F.col("uf_pasta").isin([uf or schemas.NO_UF for uf in ufs]))
    return rows.select(schema.fieldNames())
