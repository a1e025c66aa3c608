"""Regulatory and commercial classification of a generating unit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.functions.parsing import parse_power

# Results must carry these labels, word lists and limits.
SOURCE_WORDS = [
    ("UFV", ["fotovolta", "solar", "ufv"]),
    ("EOL", ["eólic", "eolic", "eol"]),
    ("CGH", ["hidr", "cgh", "pch"]),
    ("UTE", ["term", "biogás", "biogas", "biomassa", "gás natural", "gas natural", "ute"]),
]
SOURCE_OTHER = "OUTRA"
SHARED_WORDS = ["compartilhad", "cooperativ", "consórcio", "consorcio"]
MULTIPLE_WORDS = ["múltiplas", "multiplas", "muc"]
OWN_WORDS = ["própria", "propria", "local"]
MICRO_LIMIT_KW = 75
MINI_LIMIT_KW = 5000
MINI_LIMIT_HYDRO_KW = 3000
OUTLIER_LIMIT_KW = 50_000
POWER_BANDS = [
    (15, "RESIDENCIAL"),
    (75, "COMERCIAL_PEQUENO"),
    (1000, "MINIGERACAO_ALVO"),
    (5000, "INDUSTRIAL_ALVO"),
]
POWER_BAND_ABOVE = "GRANDE_CARGA"
UNDEFINED = "INDEFINIDA"
FIELD_HINTS = {
    "uf": ["sigufconsumidora", "siguf", "uf"],
    "municipio": ["nommunicipio", "municipio"],
    "cod_ibge": ["codibge", "ibge"],
    "distribuidora": ["nomagentedistribuidor", "distribuidora", "agentedistribuidor"],
    "fonte": ["nomfontegeracao", "fontegeracao", "dscfonte", "fonte"],
    "potencia_kw": ["mdapotenciainstaladakw", "potenciainstalada", "potenciakw", "mdapotencia"],
    "data_conexao": ["datconexao", "dataconexao", "datgeracaoconjuntodados"],
    "modalidade": ["nommodalidadeempreendimento", "modalidade"],
    "classe_consumo": ["dscclasseconsumo", "classeconsumo"],
}


def _mentions(text: Column, words: list[str]) -> Column:
    return reduce(Column.__or__, [text.contains(w) for w in words])


def _folded(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def source_code(text: Column) -> Column:
    """Short code of a free-text energy source; earlier codes win."""
    folded = _folded(text)
    return F.coalesce(
        *[F.when(_mentions(folded, words), F.lit(code)) for code, words in SOURCE_WORDS],
        F.lit(SOURCE_OTHER),
    )


def modality_code(text: Column) -> Column:
    """Compensation modality of a free-text description."""
    folded = _folded(text)
    several = F.when(folded.contains("empreend"), "EMUC").otherwise("MUC")
    return (
        F.when(folded.contains("remot"), "AUTOCONSUMO_REMOTO")
        .when(_mentions(folded, SHARED_WORDS), "GERACAO_COMPARTILHADA")
        .when(_mentions(folded, MULTIPLE_WORDS), several)
        .when(_mentions(folded, OWN_WORDS), "GERACAO_PROPRIA")
        .otherwise(UNDEFINED)
    )


def regulatory_band(kw: Column, source: Column) -> Column:
    """Micro or mini generation; hydro has the lower ceiling."""
    ceiling = F.when(source == "CGH", MINI_LIMIT_HYDRO_KW).otherwise(MINI_LIMIT_KW)
    return (
        F.when((kw > 0) & (kw <= MICRO_LIMIT_KW), "MICROGERACAO")
        .when((kw > 0) & (kw <= ceiling), "MINIGERACAO")
        .otherwise(UNDEFINED)
    )


def power_band(kw: Column) -> Column:
    """Commercial size class; upper bounds belong to the class."""
    usable = kw.isNotNull() & (kw > 0)
    steps = [F.when(usable & (kw <= top), F.lit(label)) for top, label in POWER_BANDS]
    return F.coalesce(*steps, F.when(usable, POWER_BAND_ABOVE), F.lit(UNDEFINED))


def outlier_flag(kw: Column, band: Column) -> Column:
    """1 for units kept for audit but left out of the totals."""
    plausible = (kw > 0) & (kw <= OUTLIER_LIMIT_KW) & (band != UNDEFINED)
    return F.when(plausible, 0).otherwise(1)


def resolve_fields(names: list[str]) -> dict[str, str | None]:
    """Real column behind every canonical field, found by name fragments.

    Works on column names only. A more specific fragment beats a looser one,
    whatever the column order.
    """
    folded = [(name.lower(), name) for name in names]
    return {
        field: next((real for hint in hints for low, real in folded if hint in low), None)
        for field, hints in FIELD_HINTS.items()
    }


def classify(df: DataFrame, *keep: str) -> DataFrame:
    """The fourteen classified columns (after the ``keep`` ones), one projection."""
    found = resolve_fields(df.columns)

    def field(name: str) -> Column:
        real = found[name]
        return F.col(f"`{real}`") if real else F.lit(None).cast("string")

    parsed = df.select(
        *keep,
        field("uf").alias("uf"),
        field("municipio").alias("municipio"),
        field("cod_ibge").alias("cod_ibge"),
        field("distribuidora").alias("distribuidora"),
        field("fonte").alias("fonte_bruta"),
        source_code(field("fonte")).alias("fonte_norm"),
        parse_power(field("potencia_kw").cast("string")).alias("potencia_kw"),
        field("data_conexao").alias("data_conexao"),
        field("modalidade").alias("modalidade_bruta"),
        modality_code(field("modalidade")).alias("modalidade_norm"),
        field("classe_consumo").alias("classe_consumo"),
    )
    power = F.col("potencia_kw")
    band = regulatory_band(power, F.col("fonte_norm"))
    return parsed.withColumns(
        {
            "faixa_regulatoria": band,
            "faixa_potencia": power_band(power),
            "is_outlier": outlier_flag(power, band),
        }
    )


def power_label(kw: Column) -> Column:
    """Display text: GW and MW with one decimal, kW with none."""
    return (
        F.when(kw >= 1e6, F.format_string("%.1f GW", kw / 1e6))
        .when(kw >= 1e3, F.format_string("%.1f MW", kw / 1e3))
        .when(kw.isNotNull(), F.format_string("%.0f kW", kw))
    )


def marker_radius(kw: Column) -> Column:
    """Map marker radius between 3 and 14; unknown or negative power is the smallest."""
    size = F.sqrt(F.greatest(kw, F.lit(0.0)) / 5000)
    return F.greatest(F.lit(3.0), F.least(F.lit(14.0), size))
