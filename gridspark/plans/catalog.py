"""Every registered query: name to a function of (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark import schemas, session
from gridspark.functions import rules
from gridspark.functions.parsing import row_hash
from gridspark.operators import (
    capacity,
    credits,
    dispatch,
    forecast,
    growth,
    load,
    measurements,
    plants,
    quality,
    registry,
    rowsets,
    settlement,
)
from gridspark.plans import inputs
from gridspark.sources import layout, pages, readers, rejects, writers
from gridspark.streaming import measurements as measurement_stream
from gridspark.streaming import registry as registry_stream
from gridspark.streaming import windows as window_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2003-01-01"
AREAS = ["S", "N", "NE", "SIN"]
SERIES_START, SERIES_END = "1995-01-01", "2001-12-31"
GROWTH_DAYS = [f"{year}-12-31" for year in range(1992, 2002)] + ["2024-01-10", "2024-01-20"]
OFFICIAL_MODIFIED = "2001-12-31T12:00:00Z"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Sums of doubles depend on their order in the last digits; compare fewer."""
    return df.withColumns({n: F.round(n, digits) for n in names})


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry fact: lean projection, first row per hash."""
    return rowsets.keep_first(registry.lean_fact(inputs.raw(spark, sf_dir)), "hash", ["id"])


def dated_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rowsets.keep_first(registry.wide_fact(inputs.raw(spark, sf_dir)), "hash", ["id"])


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.classified_fact(inputs.raw(spark, sf_dir))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.load_points(inputs.load(spark, sf_dir))


# ---- registry maintenance ------------------------------------------------


@query
def registry_fact_lean(spark, sf_dir):
    return registry.lean_fact(inputs.raw(spark, sf_dir))


@query
def registry_hashes(spark, sf_dir):
    rows = registry.lean_fact(inputs.raw(spark, sf_dir)).select(
        "cod_empreendimento", "siguf", "dscfontegeracao", "modalidade"
    )
    return rows.select("cod_empreendimento", row_hash(rows).alias("hash"))


@query
def registry_dedup_first(spark, sf_dir):
    return fact(spark, sf_dir)


@query
def registry_dedup_last(spark, sf_dir):
    return rowsets.keep_last(
        inputs.raw(spark, sf_dir).select("row_id", "hash"), ["hash"], ["row_id"]
    )


def _interrupted(spark, sf_dir):
    """A landing table and the fact table an earlier run wrote half way through it."""
    raw = inputs.raw(spark, sf_dir)
    last = inputs.table(spark, sf_dir, "orders").agg(F.max("o_orderkey") / 2).scalar()
    done = registry.lean_fact(raw.filter(F.col("row_id") <= last))
    return raw, session.materialise(rowsets.keep_first(done, "hash", ["id"]), "fact")


@query
def registry_incremental(spark, sf_dir):
    raw, stored = _interrupted(spark, sf_dir)
    added = registry.incremental_fact(raw, stored)
    return stored.withColumn("novo", F.lit(0)).unionByName(added.withColumn("novo", F.lit(1)))


@query
def registry_stream_fact(spark, sf_dir):
    """The fact that three runs of the stream make, each after a third of the rows has landed."""
    landing, fact_path, check = (session.scratch_path(spark, n) for n in ("landed", "streamed", "fact-stream"))
    raw = inputs.raw(spark, sf_dir)
    last = inputs.table(spark, sf_dir, "orders").agg(F.max("o_orderkey") + 1).scalar()
    for third in range(3):
        part = raw.filter((F.col("row_id") > last * third / 3) & (F.col("row_id") <= last * (third + 1) / 3))
        part.write.mode("append").parquet(landing)
        registry_stream.start_fact_stream(spark, landing, fact_path, check, None).awaitTermination()
    return registry_stream.read_fact(spark, fact_path)


@query
def registry_load_counts(spark, sf_dir):
    raw, stored = _interrupted(spark, sf_dir)
    return registry.load_counts(raw, stored, registry.incremental_fact(raw, stored))


@query
def registry_valid_only(spark, sf_dir):
    return registry.valid_only(fact(spark, sf_dir))


@query
def registry_enriched(spark, sf_dir):
    raw = rowsets.keep_first(inputs.raw(spark, sf_dir), "hash", ["row_id"])
    return registry.enrich(registry.lean_fact(raw), raw)


@query
def registry_wide(spark, sf_dir):
    return dated_fact(spark, sf_dir)


@query
def registry_classified(spark, sf_dir):
    return classified(spark, sf_dir)


@query
def plants_normalised(spark, sf_dir):
    return plants.normalise(inputs.plant_records(spark, sf_dir))


@query
def plants_quarantine(spark, sf_dir):
    return plants.quarantine(inputs.plant_records(spark, sf_dir)).select(
        "CodCEG", "MdaPotenciaOutorgadaKw"
    )


@query
def plants_upsert(spark, sf_dir):
    stored = plants.normalise(inputs.plant_records(spark, sf_dir))
    updates = inputs.plant_updates(spark, sf_dir)
    incoming = plants.normalise(updates, "versao")
    return plants.upsert_plants(stored, incoming, ["versao"]).drop("versao")


# ---- capacity ------------------------------------------------------------


def _tables(spark, sf_dir):
    return {
        "mmgd_raw": inputs.raw(spark, sf_dir),
        "mmgd_fato": fact(spark, sf_dir),
        "ons_carga": inputs.load(spark, sf_dir),
        "dessem_detalhe": inputs.dispatch(spark, sf_dir),
        "siga_fato": inputs.plants(spark, sf_dir),
    }


@query
def table_stats(spark, sf_dir):
    others = {n: t for n, t in _tables(spark, sf_dir).items() if not n.startswith("mmgd_")}
    profile = quality.registry_profile(inputs.raw(spark, sf_dir)).unpivot([], ["mmgd_raw", "mmgd_fato"], "tabela", "linhas")
    return capacity.table_stats(spark, others).unionByName(profile)


@query
def totals_uf(spark, sf_dir):
    return capacity.totals_by_uf(fact(spark, sf_dir))


@query
def top_ufs(spark, sf_dir):
    return capacity.totals_by_uf(fact(spark, sf_dir)).limit(10)


@query
def totals_source(spark, sf_dir):
    return rounded(capacity.totals_by_source(fact(spark, sf_dir)), 2, "potencia_total_kw")


@query
def capacity_series(spark, sf_dir):
    series = capacity.capacity_series(
        dated_fact(spark, sf_dir), None, SERIES_START, SERIES_END
    )
    return rounded(series, 2, "potencia_kw")


@query
def capacity_series_uf(spark, sf_dir):
    series = capacity.capacity_series(
        dated_fact(spark, sf_dir), "NATION_3", SERIES_START, SERIES_END, "Radiação solar"
    )
    return rounded(series, 2, "potencia_kw")


@query
def capacity_cells(spark, sf_dir):
    return rounded(capacity.capacity_cells(fact(spark, sf_dir)), 2, "potencia_total_kw")


@query
def treemap_levels(spark, sf_dir):
    cells = capacity.capacity_cells(fact(spark, sf_dir))
    return rounded(capacity.treemap_levels(cells), 2, "valor_kw")


@query
def treemap_tree(spark, sf_dir):
    tree = capacity.treemap_tree(capacity.capacity_cells(fact(spark, sf_dir)))
    leaves = tree.select(
        F.col("name").alias("uf"),
        F.col("value").alias("uf_kw"),
        F.posexplode("children").alias("posicao", "leaf"),
    ).select(
        "uf",
        "uf_kw",
        "posicao",
        F.col("leaf.name").alias("fonte"),
        F.col("leaf.value").alias("valor_kw"),
        F.col("leaf.empreendimentos").alias("empreendimentos"),
    )
    return rounded(leaves, 2, "uf_kw", "valor_kw")


@query
def capacity_combined(spark, sf_dir):
    both = capacity.capacity_combined(fact(spark, sf_dir), inputs.plants(spark, sf_dir))
    return rounded(both, 6, "potencia_mw")


@query
def totals_views(spark, sf_dir):
    return capacity.totals_views(classified(spark, sf_dir))


@query
def totals_summary(spark, sf_dir):
    return capacity.totals_summary(classified(spark, sf_dir))


@query
def export_tree(spark, sf_dir):
    tree = capacity.export_tree(classified(spark, sf_dir))
    return tree.select(
        F.col("name").alias("uf"),
        F.col("value").alias("uf_mw"),
        F.col("qtd").alias("uf_qtd"),
        F.posexplode("children").alias("posicao", "leaf"),
    ).select(
        "uf",
        "uf_mw",
        "uf_qtd",
        "posicao",
        F.col("leaf.name").alias("fonte"),
        F.col("leaf.value").alias("mw"),
        F.col("leaf.qtd").alias("qtd"),
    )


@query
def units_page(spark, sf_dir):
    return capacity.units_page(fact(spark, sf_dir), "nation_3", "Gás", limit=50, offset=5)


@query
def plants_page(spark, sf_dir):
    return plants.plants_page(inputs.plants(spark, sf_dir), kind="ufv", limit=20).select(
        "cod_ceg", "nome_empreendimento", "uf", "tipo_geracao", "potencia_outorgada_kw"
    )


def _third_page(spark, rows, key, limit, where=None):
    """Store rows in display order and turn to the third page."""
    path, after = session.scratch_path(spark, "pages"), None
    pages.write_pages(rows, path, key, file_rows=1000)
    for _ in range(3):
        page = pages.read_page(spark, path, limit, after, where)
        after = page.after
    return page.rows


@query
def units_keyset(spark, sf_dir):
    wanted = F.col("dscfontegeracao").ilike("%gás%") & (F.col("siguf") != "NATION_4")
    rows = _third_page(spark, fact(spark, sf_dir), [F.col("id")], 50, wanted)
    return rows.select("id", "cod_empreendimento", "siguf", "dscfontegeracao", "potencia_instalada_kw")


@query
def plants_keyset(spark, sf_dir):
    key = [pages.falling(F.col("potencia_outorgada_kw")), F.col("cod_ceg")]
    return _third_page(spark, inputs.plants(spark, sf_dir), key, 20).select("cod_ceg", "uf", "potencia_outorgada_kw")


@query
def load_keyset(spark, sf_dir):
    key = [pages.falling(F.unix_micros(F.col("created_at").cast("timestamp"))), pages.falling(F.col("id"))]
    return _third_page(spark, inputs.load(spark, sf_dir), key, 100, F.col("area") == "NE").select("id", "area", "tipo")


@query
def plants_geo(spark, sf_dir):
    return rounded(plants.plants_geo(inputs.plants(spark, sf_dir)), 6, "raio")


@query
def treemap_uf_plants(spark, sf_dir):
    return capacity.treemap_uf(inputs.plants(spark, sf_dir), "nation_3", "siga")


@query
def treemap_uf_top(spark, sf_dir):
    return capacity.treemap_every_uf(fact(spark, sf_dir), "mmgd", 100)


@query
def unit_labels(spark, sf_dir):
    return fact(spark, sf_dir).select(
        "id", rules.power_label(F.col("potencia_instalada_kw")).alias("rotulo")
    )


# ---- dispatch and load ---------------------------------------------------


@query
def dispatch_by_source(spark, sf_dir):
    return dispatch.generation_by_source(inputs.dispatch(spark, sf_dir), SERIES_START, SERIES_END)


@query
def dispatch_series(spark, sf_dir):
    return dispatch.generation_series(
        inputs.dispatch(spark, sf_dir), "eolica", SERIES_START, SERIES_END
    )


@query
def dispatch_now(spark, sf_dir):
    return dispatch.generation_now(inputs.dispatch(spark, sf_dir))


@query
def load_mix_now(spark, sf_dir):
    return rounded(dispatch.mix_now(inputs.dispatch(spark, sf_dir)), 2, "demanda_mw")


@query
def load_mix_now_subsystem(spark, sf_dir):
    return rounded(dispatch.mix_now(inputs.dispatch(spark, sf_dir), "ne"), 2, "demanda_mw")


@query
def load_history(spark, sf_dir):
    history = dispatch.demand_history(inputs.dispatch(spark, sf_dir), "1998-06-30", "SIN", 120)
    return rounded(history, 2, "demanda_mw")


@query
def load_daily(spark, sf_dir):
    return load.load_daily(points(spark, sf_dir), "2024-01-20", 90)


@query
def load_coverage(spark, sf_dir):
    return load.coverage(points(spark, sf_dir))


@query
def load_page(spark, sf_dir):
    return load.load_page(inputs.load(spark, sf_dir), "ne", 100, 10).drop("data_json")


@query
def load_series(spark, sf_dir):
    return load.load_series(points(spark, sf_dir), "S", "2024-01-01", "2024-02-01")


# ---- reconciliation ------------------------------------------------------


def _drift(spark, sf_dir):
    stored = load.load_points(inputs.load_with_gaps(spark, sf_dir))
    return stored, load.official_points(inputs.load_official(spark, sf_dir))


@query
def load_drift(spark, sf_dir):
    return quality.load_drift(*_drift(spark, sf_dir))


@query
def load_drift_recent(spark, sf_dir):
    stored, official = _drift(spark, sf_dir)
    return quality.load_drift(quality.recent_points(stored), official)


def _official(spark, sf_dir):
    return load.official_points(inputs.load_official(spark, sf_dir))


@query
def missing_areas(spark, sf_dir):
    partial = load.official_points(inputs.load_official_partial(spark, sf_dir))
    return quality.missing_areas(partial, AREAS)


@query
def missing_area_hours(spark, sf_dir):
    return quality.missing_area_hours(_official(spark, sf_dir), AREAS)


@query
def staleness(spark, sf_dir):
    return quality.staleness(inputs.raw(spark, sf_dir), OFFICIAL_MODIFIED)


@query
def completeness(spark, sf_dir):
    return quality.completeness(inputs.raw(spark, sf_dir), fact(spark, sf_dir))


@query
def schema_gap(spark, sf_dir):
    return quality.schema_gap(fact(spark, sf_dir))


def _report(spark, sf_dir):
    profile = quality.registry_profile(inputs.raw(spark, sf_dir))
    return quality.report(
        quality.registry_findings(profile, fact(spark, sf_dir).columns, OFFICIAL_MODIFIED),
        load_drift(spark, sf_dir),
        missing_areas(spark, sf_dir),
    )


def _counts(spark, sf_dir):
    """Rows of the tables; those of the registry in one pass."""
    others = {n: t for n, t in _tables(spark, sf_dir).items() if not n.startswith("mmgd_")}
    registry_rows = quality.registry_profile(inputs.raw(spark, sf_dir)).select(
        F.col("mmgd_raw").alias("registros_mmgd_raw"), F.col("mmgd_fato").alias("registros_mmgd_fato")
    )
    stacked = registry_rows.unionByName(quality.table_counts(others), allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


@query
def quality_report(spark, sf_dir):
    rows = quality.ordered(_report(spark, sf_dir))
    values = {n: F.col(n).try_cast("double") for n in ("valor_local", "valor_oficial")}
    return rounded(rows.withColumns(values), 3, *values, "delta_pct")


@query
def quality_breakdown(spark, sf_dir):
    return quality.breakdown(_report(spark, sf_dir))


@query
def quality_summary(spark, sf_dir):
    return quality.summary(_report(spark, sf_dir), _counts(spark, sf_dir))


# ---- measurements and credits --------------------------------------------


@query
def iot_adapted(spark, sf_dir):
    generic = measurements.adapt_generic(inputs.payloads(spark, sf_dir))
    vendor = measurements.adapt_vendor(inputs.vendor_payloads(spark, sf_dir))
    return generic.unionByName(vendor).drop("extra_json", "bateria_soc", "bateria_potencia_kw")


@query
def iot_surplus(spark, sf_dir):
    return rounded(measurements.with_surplus(inputs.iot(spark, sf_dir)), 6, "excedente_kwh")


@query
def iot_dedup(spark, sf_dir):
    return measurements.distinct_measurements(inputs.iot(spark, sf_dir, repeated=True)).drop("hash")


@query
def iot_windows(spark, sf_dir):
    return rounded(
        measurements.usage_windows(inputs.iot(spark, sf_dir)), 4, "geracao", "consumo", "excedente"
    )


@query
def iot_windows_late(spark, sf_dir):
    """Windows kept by a stream to which every third minute's measurements come late."""
    landing, path, check = (session.scratch_path(spark, n) for n in ("measured", "windows", "windows-stream"))
    rows = inputs.iot(spark, sf_dir)
    late = F.minute("ts") % 3 == 0
    for part in (rows.filter(~late), rows.filter(late)):
        part.write.mode("append").parquet(landing)
        source = spark.readStream.schema(rows.schema).parquet(landing)
        window_stream.start_windows(source, path, check).awaitTermination()
    return rounded(window_stream.windows(spark, path, flush=True), 4, "geracao", "consumo", "excedente")


@query
def iot_crediting(spark, sf_dir):
    fresh = measurements.distinct_measurements(inputs.iot(spark, sf_dir, repeated=True))
    return rounded(
        credits.credit_surplus(inputs.credits(spark, sf_dir), fresh, AS_OF), 4, "saldo_kwh"
    )


@query
def iot_running_balance(spark, sf_dir):
    """Balances that a stream keeps over two landings, the second of which repeats the first."""
    landing, path, check = (session.scratch_path(spark, n) for n in ("measured", "balance", "balance-stream"))
    for repeated in (False, True):
        rows = inputs.iot(spark, sf_dir, repeated)
        rows.write.mode("append").parquet(landing)
        source = spark.readStream.schema(rows.schema).parquet(landing)
        measurement_stream.start_balance(source, path, check).awaitTermination()
    return rounded(measurement_stream.balances(spark, path), 4, "excedente_kwh")


@query
def iot_balance(spark, sf_dir):
    return credits.client_balance(inputs.credits(spark, sf_dir), inputs.iot(spark, sf_dir), AS_OF)


@query
def clients(spark, sf_dir):
    return credits.register_clients(inputs.people(spark, sf_dir)).select(
        "id", "cpf_cnpj_hash", "tipo"
    )


@query
def credit_issue(spark, sf_dir):
    units = fact(spark, sf_dir).select(
        F.col("id").alias("mmgd_fato_id"), F.col("potencia_instalada_kw").alias("potencia_kw")
    )
    owned = units.join(inputs.holdings(spark, sf_dir), "mmgd_fato_id")
    issued = credits.issue_credits(owned, 0.8, AS_OF)
    return rounded(issued.drop("token_contrato"), 4, "saldo_kwh")


def _settled(spark, sf_dir):
    return settlement.settle(inputs.credits(spark, sf_dir), inputs.sales(spark, sf_dir))


@query
def credit_settlement(spark, sf_dir):
    return rounded(_settled(spark, sf_dir), 4, "valor_token")


@query
def credit_settlement_hot(spark, sf_dir):
    sales = inputs.hot_sales(spark, sf_dir)
    return rounded(settlement.settle(inputs.hot_credits(spark, sf_dir), sales), 4, "valor_token")


@query
def credit_settlement_refunds(spark, sf_dir):
    sales = inputs.hot_sales(spark, sf_dir, refunds=True)
    return rounded(settlement.settle(inputs.hot_credits(spark, sf_dir), sales), 4, "valor_token")


@query
def credit_balances(spark, sf_dir):
    return settlement.balances(inputs.credits(spark, sf_dir), _settled(spark, sf_dir))


@query
def credit_statement(spark, sf_dir):
    done = settlement.sold(_settled(spark, sf_dir))
    rows = credits.statement(done, inputs.credits(spark, sf_dir))
    return rounded(rows.drop("sinal_suspeito", "status"), 4, "valor_token")


@query
def credits_available(spark, sf_dir):
    return credits.available(inputs.credits(spark, sf_dir), AS_OF)


# ---- growth and forecasts ------------------------------------------------


@query
def growth_snapshot(spark, sf_dir):
    row = growth.snapshot(
        dated_fact(spark, sf_dir),
        inputs.plants(spark, sf_dir),
        points(spark, sf_dir),
        SERIES_END,
    )
    return rounded(row, 2, "mmgd_potencia_kw", "siga_potencia_kw", "ons_carga_media_mw")


def _growth_log(spark, sf_dir):
    """A stored log of snapshots; the last one is taken twice."""
    path = session.scratch_path(spark, "growth")
    tables = dated_fact(spark, sf_dir), inputs.plants(spark, sf_dir), points(spark, sf_dir)
    writers.write_snapshot_row(growth.snapshots(*tables, GROWTH_DAYS), path)
    writers.write_snapshot_row(growth.snapshot(*tables, GROWTH_DAYS[-1]), path)
    return readers.stored(spark, path, schemas.GROWTH_LOG)


@query
def growth_delta(spark, sf_dir):
    log = growth.deltas(_growth_log(spark, sf_dir))
    sums = [n for n in log.columns if n.endswith(("_kw", "_mw"))]
    return rounded(log, 2, *sums)


@query
def growth_log(spark, sf_dir):
    log = growth.recent(_growth_log(spark, sf_dir), 30)
    return rounded(log, 2, "mmgd_potencia_kw", "siga_potencia_kw", "ons_carga_media_mw")


@query
def growth_history(spark, sf_dir):
    log = growth.deltas(growth.registry_history(dated_fact(spark, sf_dir)))
    return rounded(log, 2, "mmgd_potencia_kw", "delta_mmgd_potencia_kw")


@query
def forecast_load(spark, sf_dir):
    return rounded(
        forecast.forecast_load(points(spark, sf_dir), "2024-01-31"), 6, "carga_prevista"
    )


@query
def forecast_capacity(spark, sf_dir):
    monthly = capacity.capacity_series(
        dated_fact(spark, sf_dir), None, SERIES_START, SERIES_END
    )
    return rounded(forecast.forecast_capacity(monthly, 12), 2, "potencia_kw")


# ---- files and tables, written and read back ------------------------------


@query
def source_registry_csv(spark, sf_dir):
    path = session.scratch_path(spark, "registry-csv")
    rows = fact(spark, sf_dir).select(
        F.col("cod_empreendimento").alias("CodEmpreendimento"),
        F.col("siguf").alias("SigUF"),
        F.col("dscfontegeracao").alias("DscFonteGeracao"),
    )
    rows.write.csv(path, sep=";", header=True, encoding="ISO-8859-1")
    return readers.registry_snapshot(spark, path)


@query
def source_plant_pages(spark, sf_dir):
    path = session.scratch_path(spark, "plant-pages")
    records = inputs.plant_records(spark, sf_dir).withColumn("page", F.pmod(F.hash("NomEmpreendimento"), F.lit(8)))
    fields = [c for c in records.columns if c != "page"]
    body = F.struct(
        F.struct(F.count("*").alias("total"), F.collect_list(F.struct(*fields)).alias("records")).alias("result")
    )
    pages = records.groupBy("page").agg(F.to_json(body).alias("value"))
    pages.repartition("page").write.partitionBy("page").text(path)
    return readers.plant_records(readers.plant_pages(spark, path)).select(*fields)


def _landed_load(spark, sf_dir):
    """Official load landed as JSON lines in one folder per area; the records name no area."""
    path = session.scratch_path(spark, "load")
    inputs.load_official(spark, sf_dir).write.partitionBy("area").json(path)
    return path


@query
def source_load_records(spark, sf_dir):
    rows = readers.load_records(
        spark, _landed_load(spark, sf_dir), "2024-01-05", "2024-01-25", ["S", "NE"], lines=True
    )
    return rows.select("_area", "_fonte", F.col("val_cargaglobal").try_cast("double").alias("val"))


@query
def source_recent_load(spark, sf_dir):
    rows = readers.recent_load(spark, _landed_load(spark, sf_dir), "2024-01-20", 5, lines=True)
    return rows.groupBy("_area").agg(F.count("*").alias("n"))


def _checked_load(spark, sf_dir):
    """Good rows and rejects of landed load lines, some of which are broken."""
    path = session.scratch_path(spark, "load-lines")
    inputs.load_lines(spark, sf_dir).write.partitionBy("area").text(path)
    checked = readers.load_records(spark, path, "2024-01-01", "2024-12-31", lines=True, checked=True)
    return rejects.parted(checked, "carga")


@query
def source_load_checked(spark, sf_dir):
    good, _ = _checked_load(spark, sf_dir)
    return good.select("_area", F.col("din_referenciautc").alias("ts"), F.col("val_cargaglobal").alias("val"))


def _checked_dispatch(spark, sf_dir):
    """The same of dispatch files of which some lines lack their last field and others have one too many."""
    path = session.scratch_path(spark, "dispatch-lines")
    rows = inputs.dispatch(spark, sf_dir).select("din_programacaodia", "num_patamar", "cod_subsistema", "val_demanda")
    number = F.col("num_patamar")
    line = (
        F.when(number == 7, F.concat_ws(";", "din_programacaodia", "num_patamar"))
        .when(number == 6, F.concat_ws(";", *rows.columns, F.lit("9")))
        .otherwise(F.concat_ws(";", *rows.columns))
    )
    # A header of its own for each file that a task writes.
    part = rows.select(line.alias("linha")).withColumnRenamed("linha", ";".join(rows.columns))
    part.write.option("quote", "").csv(path, sep="\t", header=True)
    return rejects.parted(readers.dispatch_files(spark, path, checked=True), "dessem")


@query
def source_dispatch_checked(spark, sf_dir):
    good, _ = _checked_dispatch(spark, sf_dir)
    return good.select("din_programacaodia", "num_patamar", "cod_subsistema", "val_demanda")


def _checked_pages(spark, sf_dir):
    path = session.scratch_path(spark, "page-texts")
    inputs.plant_page_texts(spark, sf_dir).repartition("n_regionkey").write.partitionBy("n_regionkey").text(path)
    return rejects.parted(readers.plant_pages(spark, path, checked=True), "siga")


@query
def source_pages_checked(spark, sf_dir):
    good, _ = _checked_pages(spark, sf_dir)
    return readers.plant_records(good).select("CodCEG")


def _checked_registry(spark, sf_dir):
    """Registry lines of which every tenth lacks a field."""
    path = session.scratch_path(spark, "registry-lines")
    rows = fact(spark, sf_dir).select("id", "cod_empreendimento", "dscfontegeracao")
    line = F.when(F.col("id") % 10 == 0, F.col("cod_empreendimento")).otherwise(
        F.concat_ws(";", "cod_empreendimento", "dscfontegeracao", "id")
    )
    rows.select(line.alias("CodEmpreendimento;DscFonteGeracao;Id")).write.option("quote", "").csv(
        path, sep="\t", header=True, encoding="ISO-8859-1"
    )
    return rejects.parted(readers.registry_snapshot(spark, path, checked=True), "mmgd")


@query
def source_registry_checked(spark, sf_dir):
    good, _ = _checked_registry(spark, sf_dir)
    return good.select("CodEmpreendimento", F.col("Id").cast("bigint").alias("id"))


@query
def source_rejects(spark, sf_dir):
    """What the checked reads refuse, kept and read back."""
    path = session.scratch_path(spark, "rejects")
    for part in (_checked_load, _checked_dispatch, _checked_pages, _checked_registry):
        rejects.write_rejects(part(spark, sf_dir)[1], path)
    kept = spark.read.schema("arquivo string, registro string, fonte string, motivo string").parquet(path)
    return rejects.counts(kept).drop("arquivos")


@query
def source_field_list(spark, sf_dir):
    """The field list of a landed registry file, as rows."""
    fields = readers.field_list(source_registry_csv(spark, sf_dir))
    return spark.createDataFrame([(f["id"], f["type"]) for f in fields], "id string, type string")


@query
def source_catalogue(spark, sf_dir):
    """Which resources of a landed catalogue answer the readers choose."""
    path = session.scratch_path(spark, "catalogue")
    inputs.catalogue_answer(spark, sf_dir).coalesce(1).write.text(path)
    answer = readers.catalogue(spark, path)
    chosen = {
        "zip_por_nome": readers.zip_by_name(answer),
        "zip_por_formato": readers.zip_by_format(answer),
        "csv": readers.csv_resources(answer).select("url"),
    }
    parts = [rows.select(F.lit(name).alias("escolha"), "url") for name, rows in chosen.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def source_planned_load(spark, sf_dir):
    """Programmed load of one area."""
    rows = readers.load_records(
        spark, _landed_load(spark, sf_dir), "2024-01-05", "2024-01-25", ["SIN"], readers.PLANNED, lines=True
    )
    return rows.select("_area", "_fonte", F.col("val_cargaglobal").try_cast("double").alias("val"))


def _landed_dispatch(spark, sf_dir):
    """Dispatch files of two headers in one folder."""
    path = session.scratch_path(spark, "dispatch-csv")
    rows = inputs.dispatch(spark, sf_dir)
    early = F.col("num_patamar") <= 3
    rows.filter(early).write.csv(path, sep=";", header=True)
    later = [c for c in reversed(rows.columns) if c != "val_ger_pct"]
    rows.filter(~early).select(later).write.mode("append").csv(path, sep=";", header=True)
    return readers.dispatch_files(spark, path)


@query
def source_dispatch_files(spark, sf_dir):
    return _landed_dispatch(spark, sf_dir).drop("hash", "fonte_arquivo")


@query
def sink_dispatch(spark, sf_dir):
    path = session.scratch_path(spark, "dispatch-table")
    landed = _landed_dispatch(spark, sf_dir)
    for _ in range(2):
        writers.append_dispatch(landed, path)
    table = readers.stored(spark, path, schemas.STORED_DISPATCH)
    day = F.col("din_programacaodia").alias("dia")
    return table.select(day, "num_patamar", "cod_subsistema", "val_demanda", "val_ger_pct")


@query
def sink_registry(spark, sf_dir):
    path = session.scratch_path(spark, "landing")
    records = inputs.raw(spark, sf_dir).select(F.get_json_object("raw_json", "$.SigUF").alias("SigUF"))
    for day in ("2026-01-01", "2026-01-02"):
        writers.land_registry(records, path, f"{day} 00:00:00")
    landed = readers.landed(spark, path)
    return landed.select(F.get_json_object("raw_json", "$.SigUF").alias("SigUF"), "ingested_at")


@query
def sink_load(spark, sf_dir):
    path = session.scratch_path(spark, "load-table")
    records = inputs.load_official(spark, sf_dir)
    tagged = records.withColumn("_area", F.when(F.col("area") != "N", F.col("area")).otherwise(""))
    writers.append_load(tagged.drop("area"), path, "2024-02-01 00:00:00")
    return readers.stored(spark, path, schemas.STORED_LOAD).select("area", "tipo", "ts", "val", "carga_global", "dia")


@query
def sink_plants(spark, sf_dir):
    path = session.scratch_path(spark, "plants")
    first = plants.normalise(inputs.plant_records(spark, sf_dir).withColumn("versao", F.lit(0)), "versao")
    writers.write_plants(first, path, ["versao"])
    updates = plants.normalise(inputs.plant_updates(spark, sf_dir), "versao")
    writers.write_plants(updates, path, ["versao"])
    return readers.stored(spark, path, first.drop("versao").schema).drop(layout.BUCKET)


@query
def cells_maintained(spark, sf_dir):
    """Cells kept up over three loads: two halves of the units, then changed copies of every seventh."""
    units, cells_path = session.scratch_path(spark, "units"), session.scratch_path(spark, "cells")
    rows = fact(spark, sf_dir).withColumn("versao", F.lit(0))
    changed = rows.filter("id % 7 = 0").withColumns(
        {"potencia_instalada_kw": F.col("potencia_instalada_kw") * 2, "dscfontegeracao": F.lit("outra")}
    )
    for number, load_rows in enumerate((rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1"), changed)):
        writers.write_units(load_rows, units, ["versao"], cells_path, number)
        if number == 1:
            writers.fold_cells(spark, cells_path)
    return rounded(writers.maintained_cells(spark, cells_path), 2, "potencia_total_kw")


@query
def sink_fact(spark, sf_dir):
    path = session.scratch_path(spark, "fact-table")
    rows = fact(spark, sf_dir)
    writers.write_fact(rows, path)
    return readers.stored_fact(spark, path, rows.schema)


@query
def sink_treemap(spark, sf_dir):
    path = session.scratch_path(spark, "treemap")
    writers.write_treemap(classified(spark, sf_dir), path, "2026-01-01T00:00:00")
    leaf = "array<struct<name:string,value:double,qtd:bigint>>"
    tree = spark.read.schema(f"root string, unit string, name string, value double, qtd bigint, children {leaf}").json(path)
    return tree.select("root", "unit", F.col("name").alias("uf"), F.inline("children")).select(
        "root", "unit", "uf", F.col("name").alias("fonte"), F.col("value").alias("mw"), "qtd"
    )


@query
def sink_geojson(spark, sf_dir):
    path = session.scratch_path(spark, "geojson")
    writers.write_geojson(inputs.plants(spark, sf_dir), path)
    feature = (
        "geometry struct<coordinates:array<double>>,"
        " properties struct<nome_empreendimento:string,uf:string,tipo_geracao:string,potencia_outorgada_kw:double>"
    )
    rows = spark.read.schema(feature).json(path)
    at = F.col("geometry.coordinates")
    return rows.select(at[0].alias("lon"), at[1].alias("lat"), "properties.*")


@query
def sink_report(spark, sf_dir):
    path = session.scratch_path(spark, "report")
    writers.write_report(_report(spark, sf_dir), path, "2026-01-01T00:00:00", _counts(spark, sf_dir))
    kept = spark.read.schema(schemas.FINDING).json(f"{path}/divergencias")
    totals = spark.read.schema(schemas.SUMMARY).json(f"{path}/resumo")
    rows = kept.select("tipo", "chave", "severidade", "valor_local", "valor_oficial", "delta_pct")
    numbers = {n: F.round(F.col(n).try_cast("double"), 3) for n in ("valor_local", "valor_oficial", "delta_pct")}
    # Every finding beside the totals of its report, which are one row.
    summary = totals.drop("timestamp")
    values = {c: F.lit(v).cast(kind) for (c, kind), v in zip(summary.dtypes, summary.first())}
    return rows.withColumns(numbers | values)
