import pytest
from pyspark.sql import functions as F

from gridspark.functions import rules
from gridspark.functions.parsing import leading_number, parse_power, row_hash


def apply(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", build(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


@pytest.mark.parametrize("text,number", [
    ("32,50", 32.5), ("2.00", 2.0), ("", None), (None, None), ("1.200,50", 1200.5), ("1.200", 1.2),
    ("1200.50", 1200.5), ("  7 ", 7.0), ("abc", None), ("1,2,3", None), ("1.5d", None), ("inf", None),
    ("nan", None), ("1_000", None), ("-3,5", -3.5), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0),
])
def test_parse_power(spark, text, number):
    assert apply(spark, [text], "string", parse_power) == [number]


def test_leading_number(spark):
    texts = ["1.200.50", "abc", "12.5kW", "", None, " 7.5", "-2", "inf", "NaN", "1e2", "3."]
    assert apply(spark, texts, "string", leading_number) == [
        1.2, 0.0, 12.5, 0.0, None, 7.5, -2.0, 0.0, 0.0, 100.0, 3.0,
    ]


def test_source_code(spark):
    texts = [
        "Radiação Solar", "Fotovoltaica", "EÓLICA", "Cinética do vento (eólica)", "geologic",
        "Potencial hidráulico", "PCH", "CGH", "hídrica", "térmica", "Termelétrica", "Biogás",
        "Biomassa", "GÁS NATURAL", "gas natural", "UTE", "Geotérmica", "", None, "solar térmica term",
    ]
    assert apply(spark, texts, "string", rules.source_code) == [
        "UFV", "UFV", "EOL", "EOL", "EOL", "CGH", "CGH", "CGH", "OUTRA", "OUTRA", "UTE", "UTE",
        "UTE", "UTE", "UTE", "UTE", "OUTRA", "OUTRA", "OUTRA", "UFV",
    ]


def test_modality_code(spark):
    texts = [
        "Autoconsumo remoto", "Geração compartilhada", "Cooperativa", "Consórcio",
        "Empreendimento com Múltiplas Unidades Consumidoras", "Múltiplas unidades consumidoras", "MUC",
        "Geração na própria UC", "consumo local", "Outra", "", None, "compartilhada remota",
    ]
    assert apply(spark, texts, "string", rules.modality_code) == [
        "AUTOCONSUMO_REMOTO", "GERACAO_COMPARTILHADA", "GERACAO_COMPARTILHADA", "GERACAO_COMPARTILHADA",
        "EMUC", "MUC", "MUC", "GERACAO_PROPRIA", "GERACAO_PROPRIA", "INDEFINIDA", "INDEFINIDA",
        "INDEFINIDA", "AUTOCONSUMO_REMOTO",
    ]


POWERS = [None, -1.0, 0.0, 5.0, 15.0, 15.01, 75.0, 75.01, 1000.0, 3000.0, 3000.01, 5000.0, 5000.01, 50000.0, 50000.01]


def test_regulatory_band(spark):
    und, micro, mini = "INDEFINIDA", "MICROGERACAO", "MINIGERACAO"
    head = [und, und, und, micro, micro, micro, micro, mini, mini, mini]
    solar = apply(spark, POWERS, "double", lambda kw: rules.regulatory_band(kw, F.lit("UFV")))
    hydro = apply(spark, POWERS, "double", lambda kw: rules.regulatory_band(kw, F.lit("CGH")))
    assert solar == head + [mini, mini, und, und, und]
    assert hydro == head + [und, und, und, und, und]


def test_power_band(spark):
    assert apply(spark, POWERS, "double", rules.power_band) == [
        "INDEFINIDA", "INDEFINIDA", "INDEFINIDA", "RESIDENCIAL", "RESIDENCIAL", "COMERCIAL_PEQUENO",
        "COMERCIAL_PEQUENO", "MINIGERACAO_ALVO", "MINIGERACAO_ALVO", "INDUSTRIAL_ALVO", "INDUSTRIAL_ALVO",
        "INDUSTRIAL_ALVO", "GRANDE_CARGA", "GRANDE_CARGA", "GRANDE_CARGA",
    ]


def test_outlier_flag(spark):
    assert apply(spark, POWERS, "double", lambda kw: rules.outlier_flag(kw, F.lit("MINIGERACAO"))) == [
        1, 1, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1,
    ]
    assert apply(spark, [10.0], "double", lambda kw: rules.outlier_flag(kw, F.lit("INDEFINIDA"))) == [1]


def test_power_label_and_radius(spark):
    assert apply(spark, [2.5e6, 1500.0, 999.0, None, 1e6], "double", rules.power_label) == [
        "2.5 GW", "1.5 MW", "999 kW", None, "1.0 GW",
    ]
    assert apply(spark, [None, 0.0, -5.0, 5000.0 * 49, 1e9], "double", rules.marker_radius) == [
        3.0, 3.0, 3.0, 7.0, 14.0,
    ]


def test_resolve_fields():
    found = rules.resolve_fields(["CodIBGE", "SigUFConsumidora", "UF", "DscFonteGeracao", "MdaPotenciaInstaladaKW"])
    assert found["uf"] == "SigUFConsumidora"
    assert found["cod_ibge"] == "CodIBGE"
    assert found["fonte"] == "DscFonteGeracao"
    assert found["potencia_kw"] == "MdaPotenciaInstaladaKW"
    assert found["modalidade"] is None


def test_classify_without_some_fields(spark):
    df = spark.createDataFrame([("SP", "Radiação solar", "32,50")], "SigUF string, DscFonteGeracao string, MdaPotenciaInstaladaKW string")
    row = rules.classify(df).first().asDict()
    assert row == {
        "uf": "SP", "municipio": None, "cod_ibge": None, "distribuidora": None, "fonte_bruta": "Radiação solar",
        "fonte_norm": "UFV", "potencia_kw": 32.5, "data_conexao": None, "modalidade_bruta": None,
        "modalidade_norm": "INDEFINIDA", "classe_consumo": None, "faixa_regulatoria": "MICROGERACAO",
        "faixa_potencia": "COMERCIAL_PEQUENO", "is_outlier": 0,
    }


def test_row_hash_ignores_column_order(spark):
    df = spark.createDataFrame([("x", None, 1)], "a string, b string, c int")
    one = df.select(row_hash(df).alias("h")).first()[0]
    other = df.select("c", "b", "a")
    assert one == other.select(row_hash(other).alias("h")).first()[0]
    assert len(one) == 64
