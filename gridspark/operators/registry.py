"""Distributed-generation registry: landing table to fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark import schemas
from gridspark.functions import rules
from gridspark.functions.parsing import decimal_comma, json_columns, leading_number
from gridspark.operators.rowsets import new_rows

# Labels and limits of the lean fact table.
LEAN_BANDS = [(75, "microgeracao"), (5000, "minigeracao")]
LEAN_BAND_ABOVE = "geracao"
# Fact column and the registry field that fills it.
DETAIL_FIELDS = {
    "municipio": "NomMunicipio",
    "distribuidora": "SigAgente",
    "data_conexao": "DatConexao",
    "nome_titular": "NomTitularEmpreendimento",
    "classe_producao": "DscClasseProducao",
    "subgrupo": "DscSubGrupo",
    "tipo_unidade_produtora": "DscTipoUnidadeProdutora",
}


# The connection date as a date, for pruning and series; NULL where the text is none.
CONNECTED = "dia_conexao"


def _lean_band(kw: Column) -> Column:
    steps = [F.when(kw <= top, F.lit(label)) for top, label in LEAN_BANDS]
    return F.coalesce(*steps, F.lit(LEAN_BAND_ABOVE))


def _lean_columns() -> list[Column]:
    power = F.col("potencia_instalada_kw")
    return [
        F.col("row_id").alias("id"),
        F.col("CodEmpreendimento").alias("cod_empreendimento"),
        F.col("SigUF").alias("siguf"),
        F.lower("DscFonteGeracao").alias("dscfontegeracao"),
        power,
        F.lower("SigModalidadeEmpreendimento").alias("modalidade"),
        _lean_band(power).alias("faixa_regulatoria"),
        F.col("hash"),
    ]


def _detail_columns() -> list[Column]:
    receivers = F.coalesce(F.col("QtdUcRecebeCredito").try_cast("int"), F.lit(0))
    return [
        *[
            F.coalesce(F.col(source), F.lit("")).alias(name)
            for name, source in DETAIL_FIELDS.items()
        ],
        receivers.alias("qtd_uc_recebe_credito"),
        connection_day(F.col("DatConexao")).alias(CONNECTED),
    ]


def connection_day(text: Column) -> Column:
    return text.try_cast("date")


def _parsed(raw: DataFrame, *schema: str) -> DataFrame:
    return raw.select("row_id", "hash", json_columns("raw_json", ", ".join(schema)))


def _with_power(parsed: DataFrame) -> DataFrame:
    text = F.coalesce("MdaPotenciaInstaladaKW", F.lit("0"))
    return parsed.withColumn("potencia_instalada_kw", leading_number(decimal_comma(text)))


def lean_fact(raw: DataFrame) -> DataFrame:
    """Typed projection of the landing table, one JSON parse per row.

    Missing power counts as 0 and therefore as micro generation. The landing
    row id becomes the fact id.
    """
    return _with_power(_parsed(raw, schemas.REGISTRY_JSON)).select(*_lean_columns())


def wide_fact(raw: DataFrame) -> DataFrame:
    """Lean and descriptive columns together, for a fact built in one go."""
    parsed = _parsed(raw, schemas.REGISTRY_JSON, schemas.REGISTRY_DETAIL_JSON)
    return _with_power(parsed).select(*_lean_columns(), *_detail_columns())


def valid_only(fact: DataFrame) -> DataFrame:
    """Rows a rebuild keeps: a hash and a UF field are present."""
    return fact.filter((F.col("hash") != "") & F.col("siguf").isNotNull())


def resume_point(fact: DataFrame) -> DataFrame:
    """One row ``resume``: the highest landing row already in the fact, else 0.

    The fact carries the landing row id, so the mark is a metadata-sized
    aggregate of one column instead of a join of both tables on the hash.
    """
    return fact.agg(F.coalesce(F.max("id"), F.lit(0)).alias("resume"))


def incremental_fact(raw: DataFrame, fact: DataFrame) -> DataFrame:
    """Fact rows a run adds after the resume point, known hashes ignored."""
    mark = resume_point(fact).scalar()
    return new_rows(fact, lean_fact(raw.filter(F.col("row_id") > mark)), "hash", ["id"])


def load_counts(raw: DataFrame, before: DataFrame, added: DataFrame) -> DataFrame:
    """One row: landing rows, fact rows before and after, rows added."""
    def tally(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias(name))

    parts = tally(raw, "total_raw").unionByName(
        tally(before, "fato_antes"), allowMissingColumns=True
    ).unionByName(tally(added, "novos"), allowMissingColumns=True)
    return parts.agg(
        F.max("total_raw").alias("total_raw"),
        F.max("fato_antes").alias("fato_antes"),
        (F.max("fato_antes") + F.max("novos")).alias("fato_depois"),
        F.max("novos").alias("novos"),
    )


def registry_details(raw: DataFrame) -> DataFrame:
    """The descriptive fields per hash; absent text is ``''``, absent count 0."""
    return _parsed(raw, schemas.REGISTRY_DETAIL_JSON).select("hash", *_detail_columns())


def enrich(fact: DataFrame, raw: DataFrame) -> DataFrame:
    """Fill the descriptive columns of fact rows whose ``municipio`` is NULL.

    ``raw`` must hold one row per hash. Rows already filled or without a hash
    skip the join, so only the open part of the fact is shuffled.
    """
    details = [*DETAIL_FIELDS, "qtd_uc_recebe_credito", CONNECTED]
    if "municipio" in fact.columns:
        details = [c for c in details if c in fact.columns]
    else:
        return fact.join(registry_details(raw), "hash", "left").select(*fact.columns, *details)
    is_open = F.col("municipio").isNull() & F.col("hash").isNotNull()
    found = registry_details(raw).withColumnsRenamed({c: f"new_{c}" for c in details})
    filled = fact.filter(is_open).join(found, "hash", "left")
    for column in details:
        filled = filled.withColumn(column, F.coalesce(f"new_{column}", column))
    return fact.filter(~is_open).unionByName(filled.select(fact.columns))


def classified_fact(raw: DataFrame) -> DataFrame:
    """Landing rows with every business rule applied in one projection."""
    parsed = _parsed(raw, schemas.REGISTRY_JSON, schemas.REGISTRY_DETAIL_JSON)
    return rules.classify(parsed.withColumnRenamed("row_id", "id"), "id", "hash")
