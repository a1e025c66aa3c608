"""The domain's tables derived from the TPC-H-like test tables.

The same mapping is written in SQL in ``gridspark.plans.oracles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.session import spread


# Columns used from the test tables; a given schema saves opening a file to learn it.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "events"), "event_id")


def _pick(key: Column, modulus: int, *values) -> Column:
    """One of ``values`` by remainder; the last serves every other remainder."""
    *front, last = [v if isinstance(v, Column) else F.lit(v) for v in values]
    rest = key % modulus
    return F.coalesce(*[F.when(rest == i, v) for i, v in enumerate(front)], last)


def _text(value: Column) -> Column:
    return value.cast("string")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry landing table; repeated hashes, missing power and empty UFs included."""
    orders, customer, nation = (table(spark, sf_dir, n) for n in ["orders", "customer", "nation"])
    orders = spread(orders, "o_orderkey")
    key = F.col("o_orderkey")
    scale = _pick(key, 5, 100000.0, 10000.0, 1000.0, 100.0, 5.0)
    cents = F.lpad(_text(key % 100), 2, "0")
    power = F.concat(_text(F.floor(F.col("o_totalprice") / scale)), F.lit(","), cents)
    record = F.struct(
        F.concat(F.lit("GD."), _text(key)).alias("CodEmpreendimento"),
        F.when(key % 53 == 0, "").otherwise(F.col("n_name")).alias("SigUF"),
        _pick(
            key, 7, "Radiação solar", "Cinética do vento (eólica)", "Potencial hidráulico",
            "Biogás", "Gás natural", "Geotérmica", "",
        ).alias("DscFonteGeracao"),
        _pick(
            key, 6, "Geração na própria UC", "Autoconsumo remoto", "Geração compartilhada",
            "Empreendimento com Múltiplas Unidades Consumidoras",
            "Múltiplas unidades consumidoras", "Outra",
        ).alias("SigModalidadeEmpreendimento"),
        _text(F.col("o_orderdate").cast("date")).alias("DatConexao"),
        F.col("c_name").alias("NomMunicipio"),
        F.concat(F.lit("AG"), _text(F.col("c_nationkey"))).alias("SigAgente"),
        F.when(key % 97 != 0, power).alias("MdaPotenciaInstaladaKW"),
    )
    hashed = F.when(key % 15 == 14, key - 1).otherwise(key)
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            (key + 1).alias("row_id"),
            F.lit("registry").alias("source_resource_id"),
            F.col("o_orderdate").alias("ingested_at"),
            F.to_json(record).alias("raw_json"),
            F.concat(F.lit("h"), _text(hashed)).alias("hash"),
        )
    )


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which client owns which registry unit."""
    return table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 1).alias("mmgd_fato_id"), F.col("o_custkey").alias("cliente_id")
    )


def plants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Central plants."""
    supplier, nation = (table(spark, sf_dir, n) for n in ["supplier", "nation"])
    key = F.col("s_suppkey")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("CEG"), _text(key)).alias("cod_ceg"),
        F.col("s_name").alias("nome_empreendimento"),
        F.col("n_name").alias("uf"),
        _pick(key, 4, "UHE", "UTE", "EOL", "UFV").alias("tipo_geracao"),
        (F.col("s_acctbal") * 100).alias("potencia_outorgada_kw"),
        F.when(key % 10 == 0, 0.0).otherwise((key % 30 - 30).cast("double")).alias("lat"),
        F.when(key % 11 != 0, (key % 35 - 70).cast("double")).alias("lon"),
        F.when(key % 9 == 0, "")
        .otherwise(_text(F.date_add(F.lit("1993-01-01").cast("date"), (key * 13 % 4000).cast("int"))))
        .alias("data_entrada_operacao"),
    )


def plant_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plant registry records as text, with blank codes, blank and malformed numbers."""
    supplier, nation = (table(spark, sf_dir, n) for n in ["supplier", "nation"])
    key = F.col("s_suppkey")
    number = F.replace(_text(F.col("s_acctbal").cast("decimal(18,2)")), F.lit("."), F.lit(","))
    power = (
        F.when(key % 13 == 0, "")
        .when(key % 17 == 0, F.concat(F.lit("1."), number))
        .otherwise(number)
    )
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("CEG"), _text(key)).alias("CodCEG"),
        F.col("s_name").alias("NomEmpreendimento"),
        F.col("n_name").alias("SigUFPrincipal"),
        _pick(key, 4, "UHE", "UTE", "EOL", "UFV").alias("SigTipoGeracao"),
        power.alias("MdaPotenciaOutorgadaKw"),
        F.concat(_text(key % 30 - 30), F.lit(",5")).alias("NumCoordNEmpreendimento"),
    )


def _area() -> Column:
    return _pick(F.col("user_id"), 4, "S", "NE", "N", "SIN")


def _second(ts: Column) -> Column:
    return F.date_trunc("second", ts).cast("timestamp_ntz")


def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored grid load."""
    reading = F.struct(
        _text(_second(F.col("ts"))).alias("din_referenciautc"),
        F.floor(F.col("value") * 10).alias("val_cargaglobal"),
    )
    return events(spark, sf_dir).select(
        F.col("event_id").alias("id"),
        F.lit("verificada").alias("tipo"),
        _area().alias("area"),
        F.to_json(reading).alias("data_json"),
        F.col("ts").alias("created_at"),
    )


def load_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored grid load that lacks some of the official points."""
    return load(spark, sf_dir).filter(F.col("id") % 40 != 7)


def load_official(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official load: the same points, some revised by 1 or 10 per cent."""
    key = F.col("event_id")
    revision = F.when(key % 25 == 0, 1.1).when(key % 10 == 0, 1.01).otherwise(1.0)
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "events").select(
        _area().alias("area"),
        _text(_second(F.col("ts"))).alias("din_referenciautc"),
        none.alias("din_referencia"),
        none.alias("dat_referencia"),
        _text(F.floor(F.col("value") * 10).cast("double") * revision).alias("val_cargaglobal"),
        none.alias("val_carga"),
    )


def catalogue_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue answer with a resource for each nation, CSV, ZIP by format, ZIP by name in turn."""
    key = F.col("n_nationkey")
    resource = F.struct(
        _text(key).alias("id"),
        F.concat(F.col("n_name"), _pick(key, 4, ".csv", "", ".ZIP", "")).alias("name"),
        _pick(key, 4, "CSV", "zip", "file", "JSON").alias("format"),
        F.when(key != 1, F.concat(F.lit("u"), _text(key))).otherwise("").alias("url"),
    )
    listed = F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), resource.alias("r")))), lambda x: x["r"])
    answer = F.struct(F.lit(True).alias("success"), F.struct(listed.alias("resources")).alias("result"))
    return table(spark, sf_dir, "nation").agg(F.to_json(answer).alias("value"))


def load_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official load as landed lines by area: some cut off, some without fields, some without a date."""
    key = F.col("event_id")
    point = F.struct(
        F.when(key % 50 != 2, _text(_second(F.col("ts")))).alias("din_referenciautc"),
        _text(F.floor(F.col("value") * 10).cast("double")).alias("val_cargaglobal"),
    )
    line = (
        F.when(key % 50 == 0, F.substring(F.to_json(point), 1, 20))
        .when(key % 50 == 1, '{"erro": "sem dados"}')
        .otherwise(F.to_json(point))
    )
    return table(spark, sf_dir, "events").select(_area().alias("area"), line.alias("value"))


def plant_page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plant registry pages, one for each region, as JSON; the pages of two regions are broken."""
    records = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    record = F.struct(F.concat(F.lit("CEG"), _text(F.col("s_suppkey"))).alias("CodCEG"))
    page = F.struct(F.struct(F.count("*").alias("total"), F.collect_list(record).alias("records")).alias("result"))
    region = F.col("n_regionkey")
    text = F.when(region == 0, F.substring("page", 1, 30)).when(region == 1, '{"success": false}').otherwise(F.col("page"))
    pages = records.groupBy("n_regionkey").agg(F.to_json(page).alias("page"))
    return pages.select("n_regionkey", text.alias("value"))


def load_official_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An official extract that came without area N."""
    return load_official(spark, sf_dir).filter(F.col("area") != "N")


def dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dispatch balance."""
    q = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("din_programacaodia"),
        F.col("l_linenumber").alias("num_patamar"),
        _pick(F.col("l_suppkey"), 4, "S", "NE", "N", "SE").alias("cod_subsistema"),
        F.col("l_extendedprice").alias("val_demanda"),
        (q * 10).alias("val_ger_hidraulica"),
        q.alias("val_ger_pch"),
        (q * 3).alias("val_ger_termica"),
        (q * 0.5).alias("val_ger_pct"),
        F.when(F.col("l_returnflag") != "A", q * 4).alias("val_ger_eolica"),
        (q * 2).alias("val_ger_fotovoltaica"),
        (q * 0.25).alias("val_ger_mmgd"),
    )


def iot(spark: SparkSession, sf_dir: str, repeated: bool = False) -> DataFrame:
    """Device measurements; ``repeated`` sends every twentieth of them twice."""
    rows = table(spark, sf_dir, "events")
    key = F.col("event_id")
    if repeated:
        times = F.when(key % 20 == 3, 2).otherwise(1)
        rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), times)))
    level = F.replace(F.replace("props", F.lit('{"k": ')), F.lit("}"))
    return rows.select(
        F.col("user_id").alias("cliente_id"),
        "ts",
        F.col("value").alias("geracao_kw"),
        (level.cast("double") / 4).alias("consumo_kw"),
        F.when(key % 5 == 0, (key % 7).cast("double") - 3).alias("bateria_potencia_kw"),
        F.when(key % 3 != 0, (key % 101).cast("double")).alias("bateria_soc"),
        F.col("event_type").alias("dispositivo"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device messages as JSON text, with both spellings of the open format."""
    key = F.col("event_id")
    short = key % 2 == 0
    body = F.struct(
        F.col("user_id").alias("cliente_id"),
        F.when(short, _text(F.col("ts"))).alias("timestamp"),
        F.when(~short, _text(F.col("ts"))).alias("data_hora"),
        F.when(short, F.col("value")).alias("geracao_kw"),
        F.when(~short, F.col("value")).alias("power_kw"),
        F.when(key % 3 == 0, 0.0).alias("consumo_kw"),
        F.when(key % 3 == 0, F.lit(2.5)).alias("load_kw"),
        F.when(key % 4 != 0, F.col("event_type")).alias("dispositivo"),
    )
    return events(spark, sf_dir).select(F.to_json(body).alias("value"))


def vendor_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device messages as JSON text in the vendor's format."""
    body = F.struct(
        F.col("user_id").alias("station_id"),
        _text(F.col("ts")).alias("time"),
        F.col("value").alias("power"),
        F.when(F.col("event_id") % 2 == 0, 1.5).alias("load_power"),
    )
    return events(spark, sf_dir).select(F.to_json(body).alias("value"))


def credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Energy credits."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("cliente_id"),
        F.floor(F.col("o_totalprice") / 1000).cast("double").alias("saldo_kwh"),
        F.lit(0.8).alias("valor_unitario_rs"),
        F.date_add(F.col("o_orderdate").cast("date"), 1825).alias("data_vencimento"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale requests; some exceed the balance, some name an unknown credit."""
    unknown = F.when(F.col("l_partkey") % 50 == 0, 100_000_000).otherwise(0)
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") + unknown).alias("credito_id"),
        F.col("l_linenumber").alias("seq"),
        F.col("l_partkey").alias("tie"),
        F.col("l_suppkey").alias("tie2"),
        F.col("l_quantity").alias("quantidade_kwh"),
        F.col("l_extendedprice").alias("valor_rs"),
        F.col("l_shipdate").alias("data_transacao"),
    )


HOT_CREDITS = 30


def hot_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few credits that pool all balances, for very many requests each."""
    pooled = credits(spark, sf_dir).groupBy((F.col("id") % HOT_CREDITS).alias("id"))
    return pooled.agg(F.floor(F.sum("saldo_kwh") / 4).cast("double").alias("saldo_kwh"))


def hot_sales(spark: SparkSession, sf_dir: str, refunds: bool = False) -> DataFrame:
    """Sale requests of the pooled credits; with ``refunds`` every fifth supplier gives back."""
    sign = F.when(F.col("l_suppkey") % 5 == 0, -1).otherwise(1) if refunds else F.lit(1)
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") % HOT_CREDITS).alias("credito_id"),
        F.col("l_linenumber").alias("seq"),
        F.col("l_orderkey").alias("tie"),
        F.col("l_partkey").alias("tie2"),
        (F.col("l_quantity") * sign).alias("quantidade_kwh"),
        F.col("l_extendedprice").alias("valor_rs"),
        F.col("l_shipdate").alias("data_transacao"),
    )


def plant_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of plant records: every second code, then every third again."""
    suppliers = table(spark, sf_dir, "supplier")
    rounds = suppliers.withColumn("versao", F.explode(F.array(F.lit(1), F.lit(2))))
    key = F.col("s_suppkey") * (F.col("versao") + 1)
    return rounds.select(
        F.concat(F.lit("CEG"), _text(key)).alias("CodCEG"),
        F.col("s_name").alias("NomEmpreendimento"),
        F.lit("XX").alias("SigUFPrincipal"),
        F.lit("UFV").alias("SigTipoGeracao"),
        F.concat(_text(F.col("s_suppkey")), F.lit(","), _text(F.col("versao"))).alias(
            "MdaPotenciaOutorgadaKw"
        ),
        "versao",
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients to register."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("cpf_cnpj"),
        F.when(F.col("c_custkey") % 2 == 0, "PF").otherwise("PJ").alias("tipo"),
    )
