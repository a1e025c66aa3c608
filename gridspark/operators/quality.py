"""Reconciliation of the stored tables with their official sources.

Each check returns findings; values stay numeric until ``report`` stacks them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Finding names, severities, official fields and limits.
CRITICAL = "critico"
WARNING = "atencao"
INFO = "info"
REGISTRY_PACKAGE = "relacao-de-empreendimentos-de-geracao-distribuida"
LOAD_TOLERANCE_PCT = 0.5
LOAD_CRITICAL_PCT = 5
STALE_CRITICAL_DAYS = 30
COMPLETE_WARNING_PCT = 95
COMPLETE_CRITICAL_PCT = 50
RECENT_POINTS = 500
OFFICIAL_FIELDS = [
    "distribuidora",
    "cod_empreendimento",
    "nome_titular",
    "classe_producao",
    "subgrupo",
    "qtd_uc_recebe_credito",
    "data_conexao",
    "tipo_unidade_produtora",
    "fonte",
    "potencia_instalada_kw",
    "municipio",
    "uf",
]
FIELD_ALIASES = {"siguf": "uf", "dscfontegeracao": "fonte"}


def _severity(critical: Column) -> Column:
    return F.when(critical, CRITICAL).otherwise(WARNING)


def recent_points(points: DataFrame, per_area: int = RECENT_POINTS) -> DataFrame:
    """The newest stored points of each area: how far back a routine check looks.

    Runs as a group limit in every task before the shuffle, up to the session's
    ``spark.sql.optimizer.windowGroupLimitThreshold``; beyond it Spark ranks after it.
    """
    newest = Window.partitionBy("area").orderBy(F.desc("created_at"), F.desc("id"))
    return (
        points.withColumn("__rank", F.row_number().over(newest))
        .filter(F.col("__rank") <= per_area)
        .drop("__rank")
    )


def load_drift(
    points: DataFrame, official: DataFrame, tolerance: float = LOAD_TOLERANCE_PCT
) -> DataFrame:
    """Official load points that are missing locally or differ too much.

    Among stored versions of a point the oldest one counts: a later official
    revision is what the check looks for.
    """
    usable = points.filter(F.col("ts").isNotNull() & F.col("val").isNotNull())
    stored = usable.groupBy("area", "ts").agg(
        F.min_by("val", F.struct("created_at", "id")).alias("valor_local")
    )
    pairs = (
        official.filter(F.col("ts").isNotNull() & F.col("val").isNotNull())
        .withColumnRenamed("val", "valor_oficial")
        .join(stored, ["area", "ts"], "left")
    )
    local, remote = F.col("valor_local"), F.col("valor_oficial")
    delta = F.when(remote != 0, F.abs(local - remote) / remote * 100)
    missing = local.isNull()
    return (
        pairs.withColumn("delta", delta)
        .filter(missing | (F.col("delta") > tolerance))
        .select(
            F.when(missing, "ausente_localmente")
            .otherwise("revisao_retroativa_nao_capturada")
            .alias("tipo"),
            F.concat_ws(":", "area", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("chave"),
            "valor_local",
            "valor_oficial",
            F.round("delta", 3).alias("delta_pct"),
            _severity(F.col("delta") > LOAD_CRITICAL_PCT).alias("severidade"),
        )
    )


def missing_areas(official: DataFrame, areas: list[str]) -> DataFrame:
    """Expected areas the official extract has no row for."""
    wanted = official.sparkSession.createDataFrame([(a,) for a in areas], "area string")
    seen = official.select("area").distinct()
    return wanted.join(seen, "area", "left_anti").select(
        F.lit("fetch_vazio").alias("tipo"),
        F.col("area").alias("chave"),
        F.lit(WARNING).alias("severidade"),
    )


def missing_area_hours(official: DataFrame, areas: list[str]) -> DataFrame:
    """Expected areas without a row in an hour the extract covers elsewhere."""
    hour = F.date_format("ts", "yyyy-MM-dd HH")
    seen = official.select("area", hour.alias("hora")).distinct()
    wanted = seen.select("hora").distinct().withColumn(
        "area", F.explode(F.array(*[F.lit(a) for a in areas]))
    )
    return wanted.join(seen, ["area", "hora"], "left_anti").select(
        F.lit("fetch_vazio").alias("tipo"),
        F.concat_ws(":", "area", "hora").alias("chave"),
        F.lit(WARNING).alias("severidade"),
    )


def _days_late(local: Column, official: Column) -> Column:
    return F.floor(F.timestamp_diff("SECOND", local, official) / 86400)


def staleness(raw: DataFrame, official_modified: str | None) -> DataFrame:
    """A finding when the official registry is days newer than the last landing.

    No official metadata is a finding of its own; an unreadable date is none.
    """
    if official_modified is None:
        return raw.sparkSession.range(1).select(
            F.lit("fetch_falhou").alias("tipo"),
            F.lit(REGISTRY_PACKAGE).alias("chave"),
            F.lit(None).cast("timestamp_ntz").alias("valor_local"),
            F.lit(None).cast("timestamp_ntz").alias("valor_oficial"),
            F.lit(None).cast("bigint").alias("dias"),
            F.lit(WARNING).alias("severidade"),
        )
    newest = raw.agg(F.max("ingested_at").alias("valor_local")).withColumn(
        "valor_oficial", F.lit(official_modified).try_cast("timestamp_ntz")
    )
    return (
        newest.withColumn("dias", _days_late(F.col("valor_local"), F.col("valor_oficial")))
        .filter(F.col("dias") > 0)
        .select(
            F.lit("mmgd_desatualizado").alias("tipo"),
            F.lit(REGISTRY_PACKAGE).alias("chave"),
            "valor_local",
            "valor_oficial",
            "dias",
            _severity(F.col("dias") > STALE_CRITICAL_DAYS).alias("severidade"),
        )
    )


def completeness(raw: DataFrame, fact: DataFrame) -> DataFrame:
    """A finding when too few landing rows reached the fact table."""
    tallies = raw.agg(F.count("*").alias("r"), F.lit(None).cast("bigint").alias("f")).unionByName(
        fact.agg(F.lit(None).cast("bigint").alias("r"), F.count("*").alias("f"))
    )
    done = F.when(F.col("r") > 0, F.col("f") / F.col("r") * 100)
    return (
        tallies.agg(F.max("r").alias("r"), F.max("f").alias("f"))
        .withColumn("pct", done)
        .filter(F.col("pct") < COMPLETE_WARNING_PCT)
        .select(
            F.lit("etl_raw_para_fato_incompleto").alias("tipo"),
            F.lit("mmgd_raw->mmgd_fato").alias("chave"),
            F.col("f").alias("valor_local"),
            F.col("r").alias("valor_oficial"),
            F.round(100 - F.col("pct"), 2).alias("delta_pct"),
            _severity(F.col("pct") < COMPLETE_CRITICAL_PCT).alias("severidade"),
        )
    )


def field_profile(fact: DataFrame) -> DataFrame:
    """Official registry fields: does the fact have the column, and how many rows fill it."""
    known = {FIELD_ALIASES.get(c, c): c for c in fact.columns}
    counts = [
        (F.count(F.col(known[f])) if f in known else F.max(F.lit(None).cast("bigint"))).alias(f)
        for f in OFFICIAL_FIELDS
    ]
    return (
        fact.agg(F.count("*").alias("linhas"), *counts)
        .unpivot("linhas", OFFICIAL_FIELDS, "campo", "preenchidas")
    )


def schema_gap(fact: DataFrame) -> DataFrame:
    """Official fields the fact has no column for, with the rows that lack them."""
    return (
        field_profile(fact)
        .filter(F.col("preenchidas").isNull())
        .select(
            F.lit("campo_ausente_no_schema").alias("tipo"),
            F.concat(F.lit("mmgd_fato."), "campo").alias("chave"),
            F.lit("ausente").alias("valor_local"),
            F.lit("presente na fonte ANEEL").alias("valor_oficial"),
            F.col("linhas").alias("linhas_afetadas"),
            F.lit(WARNING).alias("severidade"),
        )
    )


def as_findings(df: DataFrame) -> DataFrame:
    """Any check's output in the common finding layout, values as text."""
    def column(name: str, kind: str) -> Column:
        value = F.col(name) if name in df.columns else F.lit(None)
        return value.cast(kind).alias(name)

    return df.select(
        column("tipo", "string"),
        column("chave", "string"),
        column("valor_local", "string"),
        column("valor_oficial", "string"),
        column("delta_pct", "double"),
        column("severidade", "string"),
    )


def registry_profile(raw: DataFrame) -> DataFrame:
    """One row: landing rows, rows of the fact they make, newest landing; one pass, nothing parsed."""
    alone = F.when(F.col("hash").isNull(), F.col("row_id"))
    per_hash = raw.groupBy("hash", alone.alias("alone")).agg(
        F.count("*").alias("rows"), F.max("ingested_at").alias("newest")
    )
    return per_hash.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("mmgd_raw"),
        F.count("*").alias("mmgd_fato"),
        F.max("newest").alias("mais_recente"),
    )


def logged_profile(raw_loads: DataFrame, fact_loads: DataFrame) -> DataFrame:
    """The same row from the logs of loads, which grow with the loads and not with the tables."""
    inserted = F.coalesce(F.sum("inseridos"), F.lit(0))
    landed = raw_loads.agg(
        inserted.alias("mmgd_raw"), F.max(F.when(F.col("inseridos") > 0, F.col("ingested_at"))).alias("mais_recente")
    )
    made = fact_loads.agg(F.max_by("inseridos", "ingested_at").alias("mmgd_fato"))
    both = landed.unionByName(made, allowMissingColumns=True)
    return both.agg(
        F.max("mmgd_raw").alias("mmgd_raw"),
        F.coalesce(F.max("mmgd_fato"), F.lit(0)).alias("mmgd_fato"),
        F.max("mais_recente").alias("mais_recente"),
    )


def registry_findings(profile: DataFrame, fact_columns: list[str], official_modified: str | None) -> DataFrame:
    """``schema_gap``, ``staleness`` and ``completeness`` together, from a one-row profile read once."""

    def finding(holds: Column, kind: str, key: str, local: Column, official: Column, delta: Column, severity: Column):
        cells = {
            "tipo": F.lit(kind), "chave": F.lit(key), "valor_local": local.cast("string"),
            "valor_oficial": official.cast("string"), "delta_pct": delta.cast("double"), "severidade": severity,
        }
        return F.when(holds, F.struct(*[v.alias(n) for n, v in cells.items()]))

    none, warning = F.lit(None), F.lit(WARNING)
    raw_rows, fact_rows, newest = (F.col(c) for c in ("mmgd_raw", "mmgd_fato", "mais_recente"))
    if official_modified is None:
        late = finding(F.lit(True), "fetch_falhou", REGISTRY_PACKAGE, none, none, none, warning)
    else:
        official = F.lit(official_modified).try_cast("timestamp_ntz")
        days = _days_late(newest, official)
        severity = _severity(days > STALE_CRITICAL_DAYS)
        late = finding(days > 0, "mmgd_desatualizado", REGISTRY_PACKAGE, newest, official, none, severity)
    pct = F.when(raw_rows > 0, fact_rows / raw_rows * 100)
    incomplete = finding(
        pct < COMPLETE_WARNING_PCT, "etl_raw_para_fato_incompleto", "mmgd_raw->mmgd_fato", fact_rows, raw_rows,
        F.round(100 - pct, 2), _severity(pct < COMPLETE_CRITICAL_PCT),
    )
    known = {FIELD_ALIASES.get(c, c) for c in fact_columns}
    gaps = [
        finding(
            F.lit(True), "campo_ausente_no_schema", f"mmgd_fato.{field}", F.lit("ausente"),
            F.lit("presente na fonte ANEEL"), none, warning,
        )
        for field in OFFICIAL_FIELDS
        if field not in known
    ]
    found = F.filter(F.array(late, incomplete, *gaps), lambda f: f.isNotNull())
    return profile.select(F.inline(found))


def report(*findings: DataFrame) -> DataFrame:
    """All findings stacked, worst first through ``ordem``."""
    stacked = reduce(DataFrame.unionByName, [as_findings(f) for f in findings])
    rank = F.when(F.col("severidade") == CRITICAL, 0).when(F.col("severidade") == WARNING, 1)
    return stacked.withColumn("ordem", rank.otherwise(2))


def ordered(report_rows: DataFrame) -> DataFrame:
    """Report rows in display order."""
    return report_rows.orderBy("ordem", "tipo", "chave")


def breakdown(report_rows: DataFrame) -> DataFrame:
    """Findings per severity and kind."""
    return report_rows.groupBy("ordem", "severidade", "tipo").agg(F.count("*").alias("total"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with the rows of each table, as ``registros_<table>``."""
    counts = [rows.agg(F.count("*").alias(f"registros_{name}")) for name, rows in tables.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def summary(report_rows: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """One row: findings, critical ones, warnings, whether the run failed, rows of the tables."""
    def tally(level: str) -> Column:
        return F.count(F.when(F.col("severidade") == level, 1))

    tallied = report_rows.agg(
        F.count("*").alias("total_divergencias"),
        tally(CRITICAL).alias("criticos"),
        tally(WARNING).alias("atencoes"),
        F.when(tally(CRITICAL) > 0, 1).otherwise(0).alias("falhou"),
    )
    if counts is None:
        return tallied
    both = tallied.unionByName(counts, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
