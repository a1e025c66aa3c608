"""Energy measurements from devices: adapters, surplus, duplicates and windows.

The functions here run unchanged on batch and on streaming DataFrames, except
``distinct_measurements``, whose streaming form is in ``gridspark.streaming``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark import schemas
from gridspark.functions.parsing import first_filled, first_truthy, json_columns
from gridspark.operators.rowsets import keep_first

# Device names of the two payload kinds.
DEFAULT_DEVICE = "inversor"
VENDOR_DEVICE = "goodwe"
IDENTITY = ["cliente_id", "ts", "geracao_kw", "consumo_kw", "dispositivo"]


def adapt_generic(payloads: DataFrame, body: str = "value") -> DataFrame:
    """JSON payloads of the open format; alternative field names are accepted."""
    def either(one: str, other: str) -> Column:
        return F.coalesce(first_truthy(F.col(one), F.col(other)), F.lit(0.0)).alias(one)

    time = first_filled(F.col("timestamp"), F.col("data_hora"))
    return payloads.select(json_columns(body, schemas.MEASUREMENT_JSON)).select(
        "cliente_id",
        time.try_cast("timestamp_ntz").alias("ts"),
        either("geracao_kw", "power_kw"),
        either("consumo_kw", "load_kw"),
        "bateria_soc",
        "bateria_potencia_kw",
        F.coalesce("dispositivo", F.lit(DEFAULT_DEVICE)).alias("dispositivo"),
        F.col("extra").alias("extra_json"),
    )


def adapt_vendor(payloads: DataFrame, body: str = "value") -> DataFrame:
    """JSON payloads of the inverter vendor; the payload itself is kept."""
    none = F.lit(None).cast("double")
    fields = json_columns(body, schemas.VENDOR_JSON)
    return payloads.select(F.col(body).alias("extra_json"), fields).select(
        F.col("station_id").alias("cliente_id"),
        F.col("time").try_cast("timestamp_ntz").alias("ts"),
        F.coalesce("power", F.lit(0.0)).alias("geracao_kw"),
        F.coalesce("load_power", F.lit(0.0)).alias("consumo_kw"),
        none.alias("bateria_soc"),
        none.alias("bateria_potencia_kw"),
        F.lit(VENDOR_DEVICE).alias("dispositivo"),
        "extra_json",
    )


def surplus_kw(generation: Column, consumption: Column, battery: Column) -> Column:
    """Generation beyond consumption; a discharging (negative) battery generates."""
    discharge = F.greatest(F.lit(0.0), -F.coalesce(battery, F.lit(0.0)))
    return F.greatest(F.lit(0.0), generation - consumption + discharge)


def with_surplus(measurements: DataFrame, hours: float = 1.0) -> DataFrame:
    """Adds ``excedente_kwh``; ``hours`` is the duration a measurement stands for."""
    surplus = surplus_kw(
        F.col("geracao_kw"), F.col("consumo_kw"), F.col("bateria_potencia_kw")
    )
    return measurements.withColumn("excedente_kwh", surplus * hours)


def measurement_hash() -> Column:
    """SHA-256 over what identifies a measurement; a missing value differs from any other."""
    return F.sha2(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in IDENTITY]), 256)


def distinct_measurements(measurements: DataFrame) -> DataFrame:
    """One row per identical measurement, chosen by its remaining columns."""
    rest = [c for c in measurements.columns if c not in IDENTITY]
    keyed = measurements.withColumn("hash", measurement_hash())
    return keep_first(keyed, "hash", rest or IDENTITY)


def usage_windows(measurements: DataFrame, width: str = "1 hour") -> DataFrame:
    """Generation, consumption and surplus per client and tumbling window."""
    return (
        with_surplus(measurements)
        .groupBy(F.window("ts", width).alias("w"), "cliente_id")
        .agg(
            F.count("*").alias("medicoes"),
            F.sum("geracao_kw").alias("geracao"),
            F.sum("consumo_kw").alias("consumo"),
            F.sum("excedente_kwh").alias("excedente"),
        )
        .select(
            "cliente_id",
            F.col("w.start").alias("inicio"),
            F.col("w.end").alias("fim"),
            "medicoes",
            "geracao",
            "consumo",
            "excedente",
        )
    )


def surplus_by_client(measurements: DataFrame) -> DataFrame:
    """Σ surplus per client, clients without any left out."""
    return (
        with_surplus(measurements)
        .groupBy("cliente_id")
        .agg(F.sum("excedente_kwh").alias("excedente_kwh"))
        .filter(F.col("excedente_kwh") > 0)
    )
