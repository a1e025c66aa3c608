import datetime

import pytest
from pyspark.sql import functions as F

from gridspark.operators import load, quality
from gridspark.plans import catalog, inputs

LOAD = "id bigint, tipo string, area string, data_json string, created_at timestamp_ntz"


def at(minute):
    return datetime.datetime(2026, 1, 2, 0, minute)


def points(spark, *rows):
    data = [(i, "verificada", area, body, at(i)) for i, (area, body) in enumerate(rows)]
    return load.load_points(spark.createDataFrame(data, LOAD))


def official(spark, *rows):
    fields = "area string, din_referenciautc string, din_referencia string, dat_referencia string, val_cargaglobal string, val_carga string"
    return load.official_points(spark.createDataFrame(list(rows), fields))


def test_load_points_fall_back(spark):
    rows = points(
        spark,
        ("S", '{"din_referenciautc":"2026-01-01T00:30:00Z","val_cargaglobal":10.5}'),
        ("S", '{"din_referencia":"2026-01-01 01:00:00","val_cargaglobal":0,"valor":"7.25"}'),
        ("S", '{"din_referenciautc":"","dat_referencia":"2026-01-01","val_carga":0}'),
        ("S", '{"val_carga":3}'),
        ("S", "broken"),
    ).orderBy("id").collect()
    assert [str(r["ts"]) for r in rows] == ["2026-01-01 00:30:00", "2026-01-01 01:00:00", "2026-01-01 00:00:00", "None", "None"]
    assert [r["val"] for r in rows] == [10.5, 7.25, 0.0, 3.0, None]


def test_drift_rules(spark):
    stamp = "2026-01-01 00:00:00"
    body = '{"din_referenciautc":"%s","val_cargaglobal":%s}'
    stored = points(spark, ("S", body % (stamp, 100)), ("S", body % (stamp, 999)), ("N", body % (stamp, 100)), ("NE", body % (stamp, 100)))
    found = quality.load_drift(
        stored,
        official(
            spark,
            ("S", stamp, None, None, "100.4", None),    # oldest stored version counts: 0.398 %
            ("N", stamp, None, None, "106", None),      # 5.66 %
            ("NE", stamp, None, None, "0", "101"),      # falls back, 0.990 %
            ("SIN", stamp, None, None, "50", None),     # missing
            ("SIN", None, None, None, "50", None),      # no time: skipped
            ("S", "2026-01-01 00:30:00", None, None, None, None),  # no value: skipped
        ),
    )
    got = {r["chave"]: (r["tipo"], r["delta_pct"], r["severidade"]) for r in found.collect()}
    assert got == {
        f"N:{stamp}": ("revisao_retroativa_nao_capturada", 5.66, "critico"),
        f"NE:{stamp}": ("revisao_retroativa_nao_capturada", 0.99, "atencao"),
        f"SIN:{stamp}": ("ausente_localmente", None, "atencao"),
    }


def test_drift_skips_zero_official(spark):
    stamp = "2026-01-01 00:00:00"
    stored = points(spark, ("S", '{"din_referenciautc":"%s","val_cargaglobal":5}' % stamp))
    assert quality.load_drift(stored, official(spark, ("S", stamp, None, None, "0", "0"))).count() == 0


def test_drift_finds_what_was_seeded(spark, sf_dir):
    found = catalog.QUERIES["load_drift"](spark, sf_dir).groupBy("tipo", "severidade").count().collect()
    got = {(r["tipo"], r["severidade"]): r["count"] for r in found}
    kind = "revisao_retroativa_nao_capturada"
    assert got[(kind, "critico")] > 300 and got[(kind, "atencao")] > 500
    assert got[("ausente_localmente", "atencao")] > 200


def test_recent_points_bound(spark):
    stored = points(spark, *[("S", "{}")] * 5, *[("N", "{}")] * 2)
    assert sorted(r["id"] for r in quality.recent_points(stored, 2).collect()) == [3, 4, 5, 6]
    assert quality.recent_points(stored, 100_000).count() == 7


def test_missing_areas(spark):
    seen = spark.createDataFrame([("S",), ("S",)], "area string")
    assert sorted(r["chave"] for r in quality.missing_areas(seen, ["S", "NE", "N"]).collect()) == ["N", "NE"]


@pytest.mark.parametrize("modified,days,severity", [
    ("2026-02-02T12:00:00Z", 31, "critico"), ("2026-02-01T23:00:00+00:00", 30, "atencao"),
    ("2026-01-03T11:59:00", 1, "atencao"), ("2026-01-02T23:00:00", None, None), ("soon", None, None),
])
def test_staleness(spark, modified, days, severity):
    raw = spark.createDataFrame([(at(5),), (at(1),)], "ingested_at timestamp_ntz")
    rows = quality.staleness(raw, modified).collect()
    assert [(r["dias"], r["severidade"]) for r in rows] == ([] if days is None else [(days, severity)])


def test_staleness_without_metadata(spark):
    raw = spark.createDataFrame([(at(5),)], "ingested_at timestamp_ntz")
    assert quality.staleness(raw, None).first()["tipo"] == "fetch_falhou"


@pytest.mark.parametrize("landed,done,delta,severity", [
    (5947561, 1350000, 77.3, "critico"), (100, 94, 6.0, "atencao"), (100, 95, None, None), (0, 0, None, None),
])
def test_completeness(spark, landed, done, delta, severity):
    rows = quality.completeness(spark.range(landed), spark.range(done)).collect()
    assert [(r["delta_pct"], r["severidade"]) for r in rows] == ([] if delta is None else [(delta, severity)])


def test_schema_gap_of_wide_fact(spark, sf_dir):
    assert quality.schema_gap(catalog.dated_fact(spark, sf_dir)).count() == 0
    missing = [r["chave"] for r in quality.schema_gap(inputs.raw(spark, sf_dir)).collect()]
    assert len(missing) == 12


def test_report_order_and_summary(spark):
    raw = spark.createDataFrame([(at(5),)], "ingested_at timestamp_ntz")
    rows = quality.report(
        quality.missing_areas(spark.createDataFrame([], "area string"), ["S"]),
        quality.completeness(spark.range(10), spark.range(1)),
        quality.staleness(raw, None),
    )
    assert [r["severidade"] for r in quality.ordered(rows).collect()] == ["critico", "atencao", "atencao"]
    assert quality.summary(rows).first().asDict() == {
        "total_divergencias": 3, "criticos": 1, "atencoes": 2, "falhou": 1,
    }
    assert quality.breakdown(rows).agg(F.sum("total")).first()[0] == 3
