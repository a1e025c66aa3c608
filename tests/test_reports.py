import datetime

from pyspark.sql import functions as F

from gridspark.operators import capacity, credits, dispatch, forecast, growth, load, measurements, plants
from gridspark.plans import inputs
from gridspark import schemas

DISPATCH = schemas.DISPATCH_FILE
D1, D2 = datetime.date(2025, 5, 1), datetime.date(2025, 5, 2)


def dispatch_rows(spark, *rows):
    filled = [(day, level, sub, demand, hydro, 1.0, 2.0, None, None, 4.0, 9.0, None) for day, level, sub, demand, hydro in rows]
    return spark.createDataFrame(filled, DISPATCH)


def test_mix_takes_the_top_level_of_the_newest_day(spark):
    df = dispatch_rows(spark, (D1, 9, "S", 1.0, 1.0), (D2, 1, "S", 5.0, 7.0), (D2, 2, "S", 6.0, 8.0), (D2, 2, "NE", 7.0, 9.0), (D2, 3, "N", 9.0, 0.0))
    whole = dispatch.mix_now(df).first()
    assert (whole["num_patamar"], whole["demanda_mw"]) == (3, 9.0)
    south = dispatch.mix_now(df, "s").first()
    assert (south["num_patamar"], south["hidraulica_mw"], south["termica_mw"], south["solar_mw"]) == (2, 9.0, 2.0, 4.0)
    assert (south["hidraulica_pct"], south["eolica_pct"], south["mmgd_mw"]) == (60.0, 0.0, 9.0)
    assert dispatch.mix_now(df, "XX").count() == 0


def test_mix_of_nothing_generated(spark):
    df = spark.createDataFrame([(D1, 1, "S", 5.0, *[None] * 8)], DISPATCH)
    assert dispatch.mix_now(df).first()["hidraulica_pct"] == 0.0


def test_generation_by_source_drops_missing(spark):
    df = dispatch_rows(spark, (D1, 1, "S", 1.0, 3.005), (D2, 1, "S", 1.0, 4.0))
    got = {r["fonte"]: r["geracao_mw"] for r in dispatch.generation_by_source(df, "2025-05-01", "2025-05-02").collect()}
    assert set(got) == {"Hidráulica", "Solar", "Térmica", "PCH", "MMGD"} and got["Solar"] == 8.0
    assert dispatch.generation_by_source(df, "2030-01-01", "2030-12-31").count() == 0


def test_generation_series_unknown_source_is_hydro(spark):
    df = dispatch_rows(spark, (D1, 1, "S", 1.0, 3.0), (D1, 2, "S", 1.0, 4.0))
    assert [tuple(r) for r in dispatch.generation_series(df, "nuclear", "2025-01-01", "2026-01-01").collect()] == [(D1, 7.0)]
    assert dispatch.generation_series(df, "pct", "2025-01-01", "2026-01-01").count() == 0


def test_generation_now(spark):
    df = dispatch_rows(spark, (D1, 9, "S", 1.0, 1.0), (D2, 2, "S", 6.0, 8.0), (D2, 2, "NE", 7.0, 9.0))
    row = dispatch.generation_now(df).first()
    assert (row["data"], row["Hidráulica"], row["MMGD"]) == (D2, 9.0, 9.0)
    assert dispatch.generation_now(df.filter(F.lit(False))).count() == 0


def test_demand_history_window(spark):
    df = dispatch_rows(spark, (D1, 1, "S", 1.5, 1.0), (D2, 1, "S", 2.0, 1.0), (D2, 1, "N", 3.0, 1.0))
    assert dispatch.demand_history(df, "2025-05-03", "SIN", 1).count() == 1
    assert dispatch.demand_history(df, D1, "SIN", 5000).count() == 1
    both = dispatch.demand_history(df, "2025-05-03", "SIN", 5000).collect()
    assert sorted(r["demanda_mw"] for r in both) == [1.5, 5.0]


def test_coverage_gaps(spark):
    stamps = ["00:00:00", "00:29:59", "00:30:00", "02:00:00"]
    rows = [(i, "verificada", "S", '{"din_referenciautc":"2026-01-01 %s","val_cargaglobal":1}' % t, None) for i, t in enumerate(stamps)]
    df = spark.createDataFrame(rows, "id bigint, tipo string, area string, data_json string, created_at timestamp_ntz")
    row = load.coverage(load.load_points(df)).first()
    assert (row["registros"], row["pontos"], row["pontos_esperados"], row["lacunas"], row["maior_lacuna"]) == (4, 3, 5, 1, 2)


def test_load_series_leaves_out_the_end(spark):
    rows = [(i, "S", t, 1.0) for i, t in enumerate(["2026-01-01 00:00:00", "2026-01-01 23:30:00", "2026-01-02 00:00:00"])]
    df = spark.createDataFrame(rows, "id bigint, area string, t string, carga_global double").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    assert load.load_series(df, "S", "2026-01-01", "2026-01-02").count() == 2


def test_table_stats_missing_table(spark):
    got = {r["tabela"]: r["linhas"] for r in capacity.table_stats(spark, {"a": spark.range(3), "b": None}).collect()}
    assert got == {"a": 3, "b": None}


def test_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "uf string, fonte_norm string, potencia_kw double, is_outlier int")
    assert [tuple(r) for r in capacity.totals_summary(empty).collect()] == [("total", None, 0, 0.0)]


def test_page_limits(spark, sf_dir):
    table = inputs.plants(spark, sf_dir)
    assert plants.plants_page(table, limit=3, offset=2).count() == 3
    rows = plants.plants_page(table, uf="nation_3").collect()
    assert rows and all(r["uf"] == "NATION_3" for r in rows)
    powers = [r["potencia_outorgada_kw"] for r in plants.plants_page(table, limit=50).collect()]
    assert powers == sorted(powers, reverse=True)


def test_surplus_counts_discharge(spark):
    df = spark.createDataFrame([(1.0, 3.0, None), (5.0, 3.0, -2.0), (5.0, 3.0, 2.0), (1.0, 3.0, -1.0)], "g double, c double, b double")
    values = [r[0] for r in df.select(measurements.surplus_kw(F.col("g"), F.col("c"), F.col("b"))).collect()]
    assert values == [0.0, 4.0, 2.0, 0.0]


def test_crediting_opens_credits_and_twice_adds_twice(spark):
    table = spark.createDataFrame([(5, 1, 10.0, datetime.date(2020, 1, 1))], "id bigint, cliente_id bigint, saldo_kwh double, data_vencimento date")
    seen = spark.createDataFrame(
        [(1, 4.0, 1.0), (1, 2.0, 1.0), (9, 1.0, 5.0), (3, 8.0, 0.0)], "cliente_id bigint, geracao_kw double, consumo_kw double"
    ).withColumn("bateria_potencia_kw", F.lit(None).cast("double"))
    once = credits.credit_surplus(table, seen, "2026-01-01")
    rows = {r["id"]: (r["cliente_id"], r["saldo_kwh"], str(r["data_vencimento"])) for r in once.collect()}
    assert rows == {5: (1, 10.0, "2020-01-01"), 6: (1, 4.0, "2030-12-31"), 7: (3, 8.0, "2030-12-31")}
    twice = credits.credit_surplus(once, seen, "2026-01-01")
    assert {r["id"]: r["saldo_kwh"] for r in twice.collect()} == {5: 10.0, 6: 8.0, 7: 16.0}


def test_issue_and_available(spark):
    units = spark.createDataFrame([(3, 1, 2.0), (8, 1, 10.0)], "mmgd_fato_id bigint, cliente_id bigint, potencia_kw double")
    table = credits.issue_credits(units, 0.8, "2026-01-01", contract="0xC", start_id=4)
    rows = {r["id"]: r for r in table.collect()}
    assert set(rows) == {4, 5} and rows[4]["saldo_kwh"] == 2.0 * 24 * 30 * 0.15
    assert (rows[5]["valor_unitario_token"], rows[5]["token_contrato"], len(rows[5]["token_id"])) == (0.2, "0xC", 16)
    assert [r["id"] for r in credits.available(table, "2026-06-01", 1).collect()] == [4, 5]
    assert credits.available(table, "2031-06-01", 1).count() == 0


def test_client_balance_of_one(spark, sf_dir):
    args = inputs.credits(spark, sf_dir), inputs.iot(spark, sf_dir), "2003-01-01"
    assert credits.client_balance(*args, client=3).count() == 1
    assert credits.client_balance(*args, client=-3).count() == 0


def test_forecast_grid_keeps_empty_slots(spark):
    df = spark.createDataFrame([("S", datetime.datetime(2026, 1, 5, 10, 40), 8.0), ("S", datetime.datetime(2026, 1, 12, 10, 31), 4.0)], "area string, ts timestamp_ntz, carga_global double")
    rows = forecast.forecast_load(df, "2026-01-19", days=2).collect()
    assert len(rows) == 96
    assert [(str(r["data"]), r["carga_prevista"]) for r in rows if r["carga_prevista"] is not None] == [("2026-01-19 10:30:00", 6.0)]


def test_forecast_capacity_line(spark):
    df = spark.createDataFrame([("SP", "2025-11", 10.0), ("SP", "2025-12", 20.0), ("RJ", "2025-12", 5.0)], "siguf string, mes string, potencia_kw double")
    rows = {(r["siguf"], r["mes"]): r["potencia_kw"] for r in forecast.forecast_capacity(df, 2).collect()}
    assert round(rows[("SP", "2026-01")], 6) == 30.0 and round(rows[("SP", "2026-02")], 6) == 40.0
    assert rows[("RJ", "2026-01")] is None


def test_growth_deltas(spark):
    log = spark.createDataFrame([(D1, 2, 5.0), (D2, 5, 9.0)], "data date, mmgd_ativos bigint, mmgd_potencia_kw double")
    assert [r["delta_mmgd_ativos"] for r in growth.deltas(log).collect()] == [None, 3]


def test_no_limit_gives_all_rows(spark, sf_dir):
    table = inputs.plants(spark, sf_dir)
    assert plants.plants_page(table, limit=None).count() == table.count()
    placed = table.filter("lat <> 0 AND lon <> 0").count()
    assert plants.plants_geo(table).count() == placed


def test_missing_measures_do_not_meet(spark):
    rows = [(1, 5.0, None), (1, None, 5.0), (1, None, 5.0)]
    df = spark.createDataFrame(rows, "cliente_id bigint, geracao_kw double, consumo_kw double")
    df = df.withColumn("ts", F.lit("2025-05-01").cast("timestamp_ntz")).withColumn("dispositivo", F.lit("d"))
    assert measurements.distinct_measurements(df).count() == 2
