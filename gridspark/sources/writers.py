"""Writers. Each returns only what a caller needs to go on, all are eager."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridspark import schemas
from gridspark.functions.parsing import packed_hash, row_hash, unpacked_hash
from gridspark.operators import capacity, load, plants, quality
from gridspark.operators.rowsets import keep_first, new_rows
from gridspark.session import materialise
from gridspark.sources import layout
from gridspark.sources.readers import VERIFIED, stored

REGISTRY_RESOURCE, FACT_RESOURCE = "aneel_mmgd", "mmgd_fato"
# Folder column of landed rows, hash characters in it, folder of rows without a hash.
PREFIX, PREFIX_CHARS, NO_HASH = "prefixo", 2, "-"
# A lookup of few hashes skips row groups that lack them.
BLOOM = {"parquet.bloom.filter.enabled#hash": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
# Hashes in hexadecimal take half the room.
PACKED = {"compression": "zstd"}
# Folders of plants and units, by hash.
BUCKETS = 64


def _prefix(chars: int) -> Column:
    """Folder of a row hash: its first characters."""
    return F.when(F.coalesce("hash", F.lit("")) == "", NO_HASH).otherwise(F.substring("hash", 1, chars))


def land_registry(
    records: DataFrame,
    path: str,
    ingested_at: str,
    resource: str = REGISTRY_RESOURCE,
    prefix_chars: int = PREFIX_CHARS,
) -> dict[str, int]:
    """Append records whose hash is not landed yet; returns rows attempted and inserted.

    Rows lie in folders by hash prefix: a batch is compared with the folders it
    names only, 16^``prefix_chars`` at most. A table keeps the length it began with.
    Row ids follow the snapshot order and continue after those given out; the log
    of loads keeps them and the counts, so that neither needs the table.
    """
    spark, load_id = records.sparkSession, layout.new_load()
    last = layout.last_id(spark, path, schemas.RAW, "row_id")
    tried, kept = Observation(), Observation()
    staged = materialise(
        records.select(
            (F.lit(last + 1) + F.monotonically_increasing_id()).alias("row_id"),
            F.lit(resource).alias("source_resource_id"),
            F.lit(ingested_at).cast("timestamp_ntz").alias("ingested_at"),
            F.to_json(F.struct("*")).alias("raw_json"),
            row_hash(records).alias("hash"),
        )
        .withColumn(PREFIX, _prefix(prefix_chars))
        .observe(tried, F.count("*").alias("n"), F.max("row_id").alias("last")),
        "landing",
    )
    counts = {"attempted": tried.get["n"], "inserted": 0}
    if not counts["attempted"]:
        return counts
    note = (spark, path, load_id, resource, ingested_at, counts["attempted"], tried.get["last"])
    layout.log_load(*note, None)
    target = stored(spark, path, f"{schemas.RAW}, `{PREFIX}` string")
    same = target.filter(layout.among(PREFIX, layout.folders(staged, PREFIX)))
    fresh = layout.clustered(new_rows(same, staged, "hash", ["row_id"]), PREFIX)
    # Counted in the writing tasks themselves: each row once, even if tasks run again.
    fresh.observe(kept, F.count("*").alias("n")).write.mode("append").options(**BLOOM).partitionBy(PREFIX).parquet(path)
    counts["inserted"] = kept.get["n"]
    layout.log_load(*note, counts["inserted"])
    return counts


def append_load(records: DataFrame, path: str, created_at: str) -> None:
    """Append load records, typed and as JSON, partitioned by day; repeats stay."""
    spark = records.sparkSession
    last = layout.last_id(spark, path, schemas.STORED_LOAD, "id")

    def tag(name: str, default: str):
        return F.coalesce(name, F.lit(default)) if name in records.columns else F.lit(default)

    rows = records.select(
        (F.lit(last + 1) + F.monotonically_increasing_id()).alias("id"),
        tag("_fonte", VERIFIED).alias("tipo"),
        tag("_area", "").alias("area"),
        F.to_json(F.struct("*")).alias("data_json"),
        F.lit(created_at).cast("timestamp_ntz").alias("created_at"),
    )
    tried = Observation()
    numbered = rows.observe(tried, F.count("*").alias("n"), F.max("id").alias("last"))
    typed = materialise(
        load.load_points(numbered, "data_json").withColumn("dia", F.col("ts").cast("date")), "load"
    )
    if tried.get["n"]:
        note = (spark, path, layout.new_load(), VERIFIED, created_at, tried.get["n"], tried.get["last"])
        layout.log_load(*note, None)
        layout.clustered(typed, "dia").write.mode("append").partitionBy("dia").parquet(path)
        layout.log_load(*note, tried.get["n"])


def append_dispatch(rows: DataFrame, path: str) -> None:
    """Add the dispatch rows whose ``hash`` is not stored yet, partitioned by month.

    A row's hash covers its day, so only the stored folders of the months that come in are
    compared. That takes the hashes alone: a batch that is stored already shuffles no rows,
    and new rows are shuffled once, by the month and slot that they are written by. ``rows``
    are read again for each step and must come out the same.
    """
    fresh = rows.withColumn("mes", F.date_format("din_programacaodia", "yyyy-MM")).withColumn("hash", packed_hash(F.col("hash")))
    months = layout.folder_sizes(fresh, "mes")
    target = stored(rows.sparkSession, path, schemas.STORED_DISPATCH)
    same_months = target.filter(layout.among("mes", layout.literals(fresh, "mes", months)))
    if not same_months.isEmpty():
        known = same_months.select(packed_hash(F.col("hash")).alias("hash"))
        new = materialise(fresh.select("hash").join(known, "hash", "left_anti").distinct(), "dispatch-new")
        if new.isEmpty():
            return
        fresh = fresh.join(new.withColumnRenamed("hash", "new"), F.col("hash").eqNullSafe(F.col("new")), "left_semi")
    # A slot of a month is one task's, and a file; equal hashes share it.
    dealt = fresh.withColumn("slot", layout.slot("mes", "hash", months)).repartition("mes", "slot")
    # Equal hashes are equal rows but for the file, so the first file by name stays.
    added = keep_first(dealt, "hash", ["fonte_arquivo"], ("mes", "slot"))
    unpacked = added.withColumn("hash", unpacked_hash(F.col("hash"))).select(*rows.columns, "mes")
    unpacked.write.mode("append").options(**PACKED).partitionBy("mes").parquet(path)


def write_plants(incoming: DataFrame, path: str, order: list[str], buckets: int = BUCKETS) -> layout.Changes:
    """Replace stored plants by incoming ones of equal ``hash``; see ``layout.upsert``."""
    return layout.upsert(incoming, path, "hash", order, buckets)


def write_units(
    incoming: DataFrame, path: str, order: list[str], cells_path: str, number: int, buckets: int = BUCKETS
) -> layout.Changes:
    """Replace stored units by incoming ones of equal ``hash`` and carry the change over to the cells.

    Load ``number`` adds what it put in and takes off what it took out, both read
    from the folders it rewrote; the rest of the table is not read. A repeated load
    would find its own rows stored, so its part of the cells is written only once.
    """
    if not stored(incoming.sparkSession, f"{cells_path}/partes", capacity.CELL_DELTAS + ", `parte` bigint").filter(
        F.col("parte") == number
    ).isEmpty():
        raise ValueError(f"load {number} is in the cells already")
    changes = layout.upsert(incoming, path, "hash", order, buckets)
    layout.write_part(capacity.cell_deltas(changes.added, changes.removed), cells_path, number)
    return changes


def maintained_cells(spark: SparkSession, path: str) -> DataFrame:
    """The cells that ``write_units`` maintains: the sum of its parts."""
    return capacity.cells_of(layout.parts(spark, path, capacity.CELL_DELTAS))


def fold_cells(spark: SparkSession, path: str) -> None:
    """Sum the parts of the cells up to now, so that readers start from one."""
    parts = materialise(layout.parts(spark, path, capacity.CELL_DELTAS), "cells")
    newest = parts.agg(F.max("parte")).first()[0]
    if newest is not None:
        layout.write_snapshot(capacity.summed_deltas(parts), path, newest)


def write_treemap(classified: DataFrame, path: str, generated_at: str) -> None:
    """The Brasil, UF, source tree as JSON, one line per UF, each naming its root."""
    line = F.struct(
        F.lit("Brasil").alias("root"),
        F.lit(generated_at).alias("generated_at"),
        F.lit("MW").alias("unit"),
        "*",
    )
    tree = capacity.export_tree(classified).select(F.to_json(line).alias("value"))
    tree.write.mode("overwrite").text(path)


def write_geojson(plant_table: DataFrame, path: str, limit: int | None = None) -> None:
    """Plants with coordinates, the largest with a limit, one GeoJSON feature per line."""
    rows = plants.plants_geo(plant_table, limit)
    plants.geojson_features(rows).write.mode("overwrite").text(path)


def write_report(
    report_rows: DataFrame, path: str, timestamp: str, counts: DataFrame | None = None
) -> bool:
    """Findings and their one-row summary as JSON; True when any is critical."""
    kept = materialise(report_rows, "report")
    kept.drop("ordem").write.mode("overwrite").json(f"{path}/divergencias")
    resumo = quality.summary(kept, counts).withColumn("timestamp", F.lit(timestamp))
    resumo.write.mode("overwrite").json(f"{path}/resumo")
    return resumo.first()["falhou"] == 1


def write_cells(fact: DataFrame, path: str) -> None:
    """The treemap pre-aggregate as a table of its own."""
    capacity.capacity_cells(fact).write.mode("overwrite").parquet(path)


def write_fact(fact: DataFrame, path: str, written_at: str | None = None) -> None:
    """The fact as a new snapshot by UF: filter on ``uf_pasta`` to skip the other folders.

    ``siguf`` itself is stored as it is, the empty text included. With a time the
    load is noted in the log beside the table, for reports without a count of it.
    """
    folder = F.when(F.coalesce("siguf", F.lit("")) == "", schemas.NO_UF).otherwise(F.col("siguf"))
    kept = Observation()
    rows = layout.clustered(fact.withColumn("uf_pasta", folder), "uf_pasta")
    rows.observe(kept, F.count("*").alias("n"), F.max("id").alias("last")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy("uf_pasta").parquet(path)
    if written_at is not None:
        n, last = kept.get["n"], kept.get["last"]
        layout.log_load(fact.sparkSession, path, layout.new_load(), FACT_RESOURCE, written_at, n, last, n)


def write_snapshot_row(snapshot: DataFrame, path: str) -> None:
    """Add a growth snapshot; one of the same date is replaced."""
    snapshot.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "data"
    ).parquet(path)
