import json
import time

import pytest
from pyspark.sql import functions as F

from gridspark.operators import measurements, settlement
from gridspark.operators import credits as credit_ops
from gridspark.operators.registry import lean_fact
from gridspark.operators.rowsets import keep_first
from gridspark.plans import inputs
from gridspark.sources import writers
from gridspark.streaming import measurements as stream
from gridspark.streaming import registry as registry_stream
from gridspark.streaming import settlement as settlement_stream
from gridspark.streaming import state
from gridspark.streaming import windows as window_stream


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def messages(folder, name, *payloads):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(p) + "\n" for p in payloads))
    time.sleep(0.01)


def message(client, ts, made, used=0.0, **more):
    return {"cliente_id": client, "timestamp": ts, "geracao_kw": made, "consumo_kw": used, **more}


def run_to_memory(df, name, mode, checkpoint):
    drain(
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    )
    return df.sparkSession.table(name)


def run_to_files(df, out, checkpoint):
    drain(
        df.writeStream.format("parquet").option("path", str(out))
        .option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    )
    return df.sparkSession.read.parquet(str(out))


def test_adapters_on_a_stream(spark, tmp_path):
    messages(tmp_path / "g", "a.json", {"cliente_id": 1, "data_hora": "2026-01-01T10:00:00", "geracao_kw": 0, "power_kw": 4.5, "load_kw": 1.5})
    messages(tmp_path / "v", "a.json", {"station_id": 2, "time": "2026-01-01 11:00:00", "power": 3.0, "model": "x"})
    df = stream.measurement_stream(spark, str(tmp_path / "g"), str(tmp_path / "v"))
    rows = {r["cliente_id"]: r for r in run_to_memory(df, "adapted", "append", tmp_path / "c").collect()}
    assert (rows[1]["geracao_kw"], rows[1]["consumo_kw"], rows[1]["dispositivo"]) == (4.5, 1.5, "inversor")
    assert (rows[2]["geracao_kw"], rows[2]["consumo_kw"], rows[2]["dispositivo"]) == (3.0, 0.0, "goodwe")
    assert json.loads(rows[2]["extra_json"])["model"] == "x"


def test_windows_late_rows_and_restart(spark, tmp_path):
    folder, out, check = tmp_path / "in", tmp_path / "out", tmp_path / "c"
    messages(folder, "1.json", message(1, "2026-01-01 00:10:00", 5.0, 1.0), message(1, "2026-01-01 00:50:00", 2.0, 3.0))
    messages(folder, "2.json", message(1, "2026-01-01 05:00:00", 1.0))
    df = stream.window_stream(stream.measurement_stream(spark, str(folder), files_per_batch=1))
    first = run_to_files(df, out, check).collect()
    assert [(r["medicoes"], r["geracao"], r["excedente"]) for r in first] == [(2, 7.0, 4.0)]
    # after a restart: a row too late for its closed window, then a new hour
    messages(folder, "3.json", message(1, "2026-01-01 00:20:00", 100.0))
    messages(folder, "4.json", message(1, "2026-01-01 09:00:00", 1.0))
    rows = run_to_files(df, out, check).orderBy("inicio").collect()
    assert [(r["medicoes"], r["geracao"]) for r in rows] == [(2, 7.0), (1, 1.0)]


def test_closed_windows_equal_batch(spark, sf_dir, tmp_path):
    src = tmp_path / "iot"
    batch = inputs.iot(spark, sf_dir)
    batch.write.parquet(str(src))
    streamed = run_to_files(
        stream.window_stream(spark.readStream.schema(batch.schema).parquet(str(src))), tmp_path / "o", tmp_path / "c"
    )
    closed = streamed.agg(F.max("fim")).first()[0]
    columns = ["cliente_id", "inicio", "medicoes"]
    want = measurements.usage_windows(batch.withColumn("ts", F.col("ts").cast("timestamp"))).filter(F.col("fim") <= closed)
    assert sorted(streamed.select(columns).collect()) == sorted(want.select(columns).collect())
    assert streamed.count() > 1000


def test_running_balance(spark, tmp_path):
    folder, ledger = tmp_path / "in", str(tmp_path / "ledger")
    once = message(1, "2026-01-01 00:10:00", 5.0, 1.0)
    messages(folder, "1.json", once, message(2, "2026-01-01 00:10:00", 1.0, 4.0))
    messages(folder, "2.json", once, message(1, "2026-01-01 00:20:00", 1.0, 2.0, bateria_potencia_kw=-3.0))
    source = stream.measurement_stream(spark, str(folder), files_per_batch=1)
    drain(stream.start_crediting(source, ledger, str(tmp_path / "c")))
    rows = {r["cliente_id"]: r for r in stream.running_balance(spark, ledger).collect()}
    assert {k: (r["excedente_kwh"], r["medicoes"]) for k, r in rows.items()} == {1: (6.0, 2), 2: (0.0, 1)}


def test_late_measurements_are_credited_once(spark, tmp_path):
    folder, ledger = tmp_path / "in", str(tmp_path / "ledger")
    late, timeless = message(1, "2026-01-02 00:10:00", 7.0), message(1, None, 2.0)
    messages(folder, "1.json", message(1, "2026-01-05 00:10:00", 1.0), timeless)
    messages(folder, "2.json", late)
    messages(folder, "3.json", message(1, "2026-01-08 00:10:00", 1.0))
    messages(folder, "4.json", late, timeless)  # repeated, days later
    source = stream.measurement_stream(spark, str(folder), files_per_batch=1)
    drain(stream.start_crediting(source, ledger, str(tmp_path / "c")))
    assert [(r["excedente_kwh"], r["medicoes"]) for r in stream.running_balance(spark, ledger).collect()] == [(11.0, 4)]


def test_crediting_ignores_duplicates_and_replays(spark, tmp_path):
    folder, ledger = tmp_path / "in", str(tmp_path / "ledger")
    table = spark.createDataFrame([(7, 1, 10.0, "2030-01-01"), (8, 1, 5.0, "2029-01-01"), (9, 1, 5.0, "2020-01-01")], "id bigint, cliente_id bigint, saldo_kwh double, d string")
    table = table.withColumn("data_vencimento", F.col("d").cast("date")).drop("d")
    same = message(1, "2026-01-01 00:10:00", 5.0, 1.0)
    messages(folder, "1.json", same, same, message(2, "2026-01-01 00:15:00", 3.0))
    messages(folder, "2.json", same, message(1, "2026-01-01 00:20:00", 2.0, 1.0))
    source = stream.measurement_stream(spark, str(folder), files_per_batch=1)
    drain(stream.start_crediting(source, ledger, str(tmp_path / "c")))

    def balances():
        rows = stream.credited(table, ledger, "2026-01-02").collect()
        return {(r["id"], r["cliente_id"]): r["saldo_kwh"] for r in rows}

    want = {(7, 1): 10.0, (8, 1): 10.0, (9, 1): 5.0, (10, 2): 3.0}
    assert balances() == want
    # the whole stream again from a fresh checkpoint overwrites its batches
    drain(stream.start_crediting(source, ledger, str(tmp_path / "c2")))
    assert balances() == want


def test_fact_stream_equals_batch(spark, sf_dir, tmp_path):
    landing, fact = str(tmp_path / "raw"), str(tmp_path / "fact")
    raw = inputs.raw(spark, sf_dir)
    half = raw.agg((F.max("row_id") / 2).cast("bigint")).first()[0]
    raw.filter(F.col("row_id") <= half).coalesce(1).write.mode("append").parquet(landing)
    drain(registry_stream.start_fact_stream(spark, landing, fact, str(tmp_path / "c")))
    raw.filter(F.col("row_id") > half).coalesce(1).write.mode("append").parquet(landing)
    drain(registry_stream.start_fact_stream(spark, landing, fact, str(tmp_path / "c")))
    got = registry_stream.read_fact(spark, fact)
    want = keep_first(lean_fact(raw), "hash", ["id"])
    assert got.count() == want.count()
    assert got.select("id", "hash").exceptAll(want.select("id", "hash")).isEmpty()
    # nothing new: nothing changes
    drain(registry_stream.start_fact_stream(spark, landing, fact, str(tmp_path / "c")))
    assert registry_stream.read_fact(spark, fact).count() == want.count()


def test_late_measurements_restate_windows(spark, tmp_path):
    folder, out, check = tmp_path / "in", str(tmp_path / "windows"), str(tmp_path / "c")
    hour = "2026-01-01 {:02d}:10:00".format
    messages(folder, "1.json", message(1, hour(0), 5.0, 1.0), message(2, hour(0), 1.0), message(1, None, 9.0))
    messages(folder, "2.json", message(1, hour(6), 1.0))
    messages(folder, "3.json", message(1, hour(0), 2.0), message(1, hour(6), 4.0), message(2, hour(3), 1.5))
    source = stream.measurement_stream(spark, str(folder), files_per_batch=1)
    drain(window_stream.start_windows(source, out, check))

    def found(rows):
        return sorted((r["cliente_id"], r["inicio"].hour, r["medicoes"], r["geracao"], r["tardias"], r["versao"]) for r in rows.collect())

    closed = [(1, 0, 2, 7.0, 1, 2), (2, 0, 1, 1.0, 0, 0), (2, 3, 1, 1.5, 1, 2)]
    assert found(window_stream.windows(spark, out)) == closed
    assert found(window_stream.windows(spark, out, flush=True)) == sorted([*closed, (1, 6, 2, 5.0, 0, 2)])
    first = found(window_stream.versions(spark, out).filter("cliente_id = 1 AND hour(inicio) = 0"))
    assert first == [(1, 0, 1, 5.0, 0, 0), (1, 0, 2, 7.0, 1, 2)]
    kinds = "cliente_id bigint, ts timestamp_ntz, geracao_kw double"
    aside = window_stream.set_aside(spark, out, kinds).collect()
    assert sorted((r["cliente_id"], r["geracao_kw"], r["motivo"]) for r in aside) == [
        (1, 2.0, "tardia"), (1, 9.0, "sem_hora"), (2, 1.5, "tardia"),
    ]
    # folded parts are read no more; the whole stream again gives the same windows
    window_stream.fold(spark, out)
    spoil(tmp_path / "windows" / "janelas" / "partes")
    messages(folder, "4.json", message(2, hour(0), 3.0))
    drain(window_stream.start_windows(source, out, check))
    assert found(window_stream.windows(spark, out))[1] == (2, 0, 2, 4.0, 1, 3)
    drain(window_stream.start_windows(source, str(tmp_path / "again"), str(tmp_path / "c2")))
    drain(window_stream.start_windows(source, str(tmp_path / "again"), str(tmp_path / "c3")))
    assert found(window_stream.windows(spark, str(tmp_path / "again"), flush=True)) == found(
        window_stream.windows(spark, out, flush=True)
    )


def spoil(folder):
    """Make every data file of a folder unreadable."""
    files = [p for p in folder.rglob("*.parquet")]
    assert files
    for file in files:
        file.write_bytes(b"spoilt")
    for checksum in folder.rglob(".*.crc"):
        checksum.write_bytes(b"")


def landing_part(spark, path, first, last):
    rows = spark.range(first, last).select(
        F.col("id").alias("row_id"), F.lit("r").alias("source_resource_id"), F.lit(None).cast("timestamp_ntz").alias("ingested_at"),
        F.lit('{"SigUF": "SP", "MdaPotenciaInstaladaKW": "3"}').alias("raw_json"),
        F.when(F.col("id") % 10 != 9, F.concat(F.lit("h"), F.col("id") % 7)).alias("hash"),
    )
    rows.repartition(3).write.mode("append").parquet(path)


def test_fact_batches_read_no_earlier_folder(spark, tmp_path):
    landing, fact, check = str(tmp_path / "raw"), tmp_path / "fact", str(tmp_path / "c")
    landing_part(spark, landing, 0, 4)
    drain(registry_stream.start_fact_stream(spark, landing, str(fact), check))
    spoil(fact / "batch_id=0")
    landing_part(spark, landing, 4, 40)
    drain(registry_stream.start_fact_stream(spark, landing, str(fact), check))
    later = spark.read.schema(registry_stream.FACT).parquet(str(fact / "batch_id=1"))
    # hashes h0 to h3 came before; the least id of a batch stays; NULL hashes all stay
    got = sorted(((r["hash"] or "", r["id"]) for r in later.collect()))
    assert got == [("", 9), ("", 19), ("", 29), ("", 39), ("h4", 4), ("h5", 5), ("h6", 6)]


def test_fact_batches_save_what_they_changed(spark, tmp_path):
    landing, fact, check = str(tmp_path / "raw"), str(tmp_path / "fact"), tmp_path / "c"
    before = {name: spark.conf.get(name, None) for name in state.SETTINGS}
    for first, last in ((0, 4), (4, 40)):
        landing_part(spark, landing, first, last)
        drain(registry_stream.start_fact_stream(spark, landing, fact, str(check)))
    # Before, each batch saved the files of the store itself.
    saved = {p.suffix for p in (check / "state").rglob("[0-9]*.*")}
    assert ".changelog" in saved and ".zip" not in saved
    assert {name: spark.conf.get(name, None) for name in state.SETTINGS} == before


def test_the_fact_stream_reads_landed_folders(spark, tmp_path):
    landing, fact, check = str(tmp_path / "raw"), str(tmp_path / "fact"), str(tmp_path / "c")
    for day in (1, 2):
        records = spark.range(30 * day).select(F.concat(F.lit("GD."), "id").alias("CodEmpreendimento"), F.lit("SP").alias("SigUF"))
        writers.land_registry(records, landing, f"2026-07-0{day} 00:00:00")
        drain(registry_stream.start_fact_stream(spark, landing, fact, check))
    rows = registry_stream.read_fact(spark, fact)
    assert rows.count() == rows.select("hash").distinct().count() == 60


def test_a_failed_fact_batch_is_repeated(spark, tmp_path, monkeypatch):
    landing, fact, check = str(tmp_path / "raw"), str(tmp_path / "fact"), str(tmp_path / "c")
    landing_part(spark, landing, 0, 5)
    drain(registry_stream.start_fact_stream(spark, landing, fact, check))
    landing_part(spark, landing, 2, 30)
    real = registry_stream.ledger.write_batch

    def failing(*args):
        real(*args)
        raise OSError("lost after writing")

    monkeypatch.setattr(registry_stream.ledger, "write_batch", failing)
    query = registry_stream.start_fact_stream(spark, landing, fact, check)
    with pytest.raises(Exception, match="lost after writing"):
        query.awaitTermination()
    monkeypatch.setattr(registry_stream.ledger, "write_batch", real)
    drain(registry_stream.start_fact_stream(spark, landing, fact, check))
    rows = registry_stream.read_fact(spark, fact).collect()
    assert sorted(r["id"] for r in rows if r["hash"]) == [0, 1, 2, 3, 4, 5, 6]
    assert sorted(r["id"] for r in rows if not r["hash"]) == [9, 19, 29]


def test_stateful_balance_equals_batch(spark, tmp_path):
    folder, out, check = tmp_path / "in", str(tmp_path / "balance"), str(tmp_path / "c")
    for batch in range(7):
        messages(
            folder, f"{batch}.json",
            *[message(c, f"2026-01-0{1 + (batch * c) % 5} 00:{m:02d}:00", float(m + batch % 2), 1.0) for c in (1, 2, 3) for m in range(batch, batch + 4)],
        )
    source = stream.measurement_stream(spark, str(folder), files_per_batch=1)
    drain(stream.start_balance(source, out, check, snapshot_every=3))

    def want():
        every = measurements.distinct_measurements(measurements.adapt_generic(spark.read.text(str(folder))))
        return sorted(measurements.with_surplus(every).groupBy("cliente_id").agg(F.sum("excedente_kwh"), F.count("*")).collect())

    assert sorted(stream.balances(spark, out).collect()) == want()
    assert spark.read.parquet(f"{out}/snapshots").select("batch_id").distinct().count() == 2
    # earlier folders are not needed any more, and a client without news is not written
    spoil(tmp_path / "balance" / "updates" / "batch_id=0")
    messages(folder, "8.json", message(2, "2026-02-01 00:00:00", 9.0, 1.0))
    drain(stream.start_balance(source, out, check, snapshot_every=3))
    assert sorted(stream.balances(spark, out).collect()) == want()
    assert spark.read.parquet(f"{out}/updates/batch_id=7").count() == 1


def test_settlement_stream_equals_batch(spark, tmp_path):
    credits = spark.createDataFrame([(i, 1, 10.0 * i) for i in range(1, 6)], "id bigint, cliente_id bigint, saldo_kwh double")
    folder, out = tmp_path / "in", str(tmp_path / "out")
    requests = [
        {"credito_id": i % 6 + 1, "seq": i, "tie": i, "tie2": 0, "quantidade_kwh": float(i % 7 + 1), "valor_rs": 4.0,
         "data_transacao": f"2026-01-01T00:{i:02d}:00"}
        for i in range(48)
    ]
    messages(folder, "1.json", *requests[:20])
    messages(folder, "2.json", *requests[20:35])
    source = settlement_stream.sale_stream(spark, str(folder), files_per_batch=1)
    drain(settlement_stream.start_settlement(source, credits, out, str(tmp_path / "c"), snapshot_every=2))
    # neither outcomes nor balances from before the snapshot are read again
    kept = {f: f.read_bytes() for f in (tmp_path / "out").rglob("*") if f.is_file()}
    spoil(tmp_path / "out" / "desfechos")
    spoil(tmp_path / "out" / "saldos" / "partes")
    messages(folder, "3.json", *requests[35:])
    drain(settlement_stream.start_settlement(source, credits, out, str(tmp_path / "c"), snapshot_every=2))
    for file, data in kept.items():
        file.write_bytes(data)
    got = settlement_stream.outcomes(spark, out)
    whole = settlement.settle(credits, spark.read.schema(got.schema).json(str(folder)).drop("status", "sinal_suspeito", "tipo"))
    assert {r["seq"]: r["status"] for r in got.collect()} == {r["seq"]: r["status"] for r in whole.collect()}
    left = settlement.balances(credits, got).collect()
    assert {r["id"]: r["saldo_kwh"] for r in left} == {
        r["id"]: r["saldo_kwh"] for r in settlement.balances(credits, whole).collect()
    }
    assert {r["id"]: r["saldo_kwh"] for r in left} == {
        r["id"]: r["saldo_kwh"] for r in settlement_stream.left_balances(credits, out).collect()
    }
    owner = credit_ops.statement(settlement.sold(got), credits, 1)
    assert owner.count() == settlement.sold(got).count() > 0
