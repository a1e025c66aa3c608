"""Central power plants: normalisation, maintenance and look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions import rules
from gridspark.functions.parsing import decimal_comma, row_hash
from gridspark.operators.rowsets import first_rows, upsert

# Output column and the plant record field it comes from.
TEXT_FIELDS = {
    "cod_ceg": "CodCEG",
    "nome_empreendimento": "NomEmpreendimento",
    "uf": "SigUFPrincipal",
    "tipo_geracao": "SigTipoGeracao",
    "fase_usina": "DscFaseUsina",
    "fonte_combustivel": "DscFonteCombustivel",
    "data_entrada_operacao": "DatEntradaOperacao",
    "proprietario": "DscPropriRegimePariticipacao",
    "municipios": "DscMuninicpios",
}
NUMBER_FIELDS = {
    "potencia_outorgada_kw": "MdaPotenciaOutorgadaKw",
    "potencia_fiscalizada_kw": "MdaPotenciaFiscalizadaKw",
    "garantia_fisica_kw": "MdaGarantiaFisicaKw",
    "lat": "NumCoordNEmpreendimento",
    "lon": "NumCoordEEmpreendimento",
}


def _measure(text: Column) -> Column:
    """Decimal-comma number: empty is 0.0, malformed is NULL."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(0.0)).otherwise(
        decimal_comma(text).try_cast("double")
    )


def normalise(records: DataFrame, *keep: str) -> DataFrame:
    """Typed plant table; ``hash`` is the plant code, or the row hash without one.

    ``keep`` names bookkeeping columns to carry over.
    """
    have = set(records.columns)

    def source(field: str) -> Column:
        return F.col(field) if field in have else F.lit(None).cast("string")

    texts = [F.coalesce(source(f), F.lit("")).alias(n) for n, f in TEXT_FIELDS.items()]
    numbers = [_measure(source(f)).alias(n) for n, f in NUMBER_FIELDS.items()]
    # Bookkeeping columns must not tell apart two versions of a plant without a code.
    fields = [*TEXT_FIELDS.values(), *NUMBER_FIELDS.values()]
    code = F.coalesce(source("CodCEG"), F.lit(""))
    key = F.when(code != "", code).otherwise(row_hash(records, [f for f in fields if f in have]))
    return records.select(*texts, *numbers, key.alias("hash"), *keep)


def quarantine(records: DataFrame) -> DataFrame:
    """Plant records with a number that does not parse."""
    broken = None
    for field in NUMBER_FIELDS.values():
        if field in records.columns:
            bad = _measure(F.col(field)).isNull()
            broken = bad if broken is None else broken | bad
    return records.filter(F.lit(False) if broken is None else broken)


def upsert_plants(stored: DataFrame, incoming: DataFrame, order: list[str]) -> DataFrame:
    """Stored plants with incoming ones replacing those of equal ``hash``."""
    return upsert(stored, incoming, F.col("hash"), order)


def plants_page(
    plants: DataFrame,
    kind: str | None = None,
    uf: str | None = None,
    limit: int | None = 100,
    offset: int = 0,
) -> DataFrame:
    """Largest plants first, optionally of one kind or UF; all of them without a limit."""
    rows = plants
    if kind:
        rows = rows.filter(F.col("tipo_geracao") == kind.upper())
    if uf:
        rows = rows.filter(F.col("uf") == uf.upper())
    largest = rows.orderBy(F.desc("potencia_outorgada_kw"), "cod_ceg").offset(offset)
    return first_rows(largest, limit)


def plants_geo(plants: DataFrame, limit: int | None = None) -> DataFrame:
    """Plants with usable coordinates, the largest with a limit, and their map marker radius."""
    placed = plants.filter((F.col("lat") != 0) & (F.col("lon") != 0))
    if limit is not None:
        placed = placed.orderBy(F.desc("potencia_outorgada_kw"), "cod_ceg").limit(limit)
    return (
        placed.select(
            "cod_ceg",
            "nome_empreendimento",
            "uf",
            "tipo_geracao",
            "potencia_outorgada_kw",
            "lat",
            "lon",
            rules.marker_radius(F.col("potencia_outorgada_kw")).alias("raio"),
        )
    )


def geojson_features(plants: DataFrame) -> DataFrame:
    """One GeoJSON feature per plant, as text; coordinates are longitude, latitude."""
    fields = ["nome_empreendimento", "uf", "tipo_geracao", "potencia_outorgada_kw", "lat", "lon"]
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")).alias(
            "geometry"
        ),
        F.struct(*fields).alias("properties"),
    )
    return plants.select(F.to_json(feature).alias("value"))
