import datetime
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridspark import schemas
from gridspark.functions import parsing
from gridspark.operators import capacity, growth, load, quality, registry, rowsets
from gridspark.plans import catalog, inputs
from gridspark.sources import layout, readers, writers


def text_of(folder):
    parts = [os.path.join(folder, f) for f in sorted(os.listdir(folder)) if f.startswith("part-")]
    return "".join(open(p, encoding="utf-8").read() for p in parts)


def test_landing_twice_inserts_once(spark, tmp_path):
    csv = tmp_path / "in.csv"
    csv.write_bytes("SigUF;Nome\nSP;Água\nRJ;b\nSP;Água\n".encode("latin-1"))
    records = readers.registry_snapshot(spark, str(csv))
    out = str(tmp_path / "raw")
    first = writers.land_registry(records, out, "2026-07-01 00:00:00")
    assert first == {"attempted": 3, "inserted": 2}
    assert writers.land_registry(records, out, "2026-07-02 00:00:00") == {"attempted": 3, "inserted": 0}
    csv.write_bytes("SigUF;Nome\nSP;Água\nMG;c\n".encode("latin-1"))
    assert writers.land_registry(records, out, "2026-07-03 00:00:00") == {"attempted": 2, "inserted": 1}
    table = readers.landed(spark, out).orderBy("row_id").collect()
    assert [json.loads(r["raw_json"])["SigUF"] for r in table] == ["SP", "RJ", "MG"]
    assert len({r["row_id"] for r in table}) == 3
    assert json.loads(table[0]["raw_json"])["Nome"] == "Água"


def spoil(folder):
    """Make every data file of a folder unreadable."""
    for file in folder.rglob("*.parquet"):
        file.write_bytes(b"spoilt")
    for checksum in folder.rglob(".*.crc"):
        checksum.write_bytes(b"")


def spoil_but(folder, column, names):
    """The same for all folders of ``column`` but some."""
    others = [f for f in folder.glob(f"{column}=*") if f.name.split("=")[1] not in names]
    for other in others:
        spoil(other)
    return len(others)


def registry_rows(spark, first, last):
    return spark.range(first, last).select(F.concat(F.lit("GD."), "id").alias("Cod"), F.lit("SP").alias("SigUF"))


def test_a_small_landing_reads_the_prefixes_it_names(spark, tmp_path):
    out = str(tmp_path / "raw")
    assert writers.land_registry(registry_rows(spark, 0, 3000), out, "2026-07-01 00:00:00")["inserted"] == 3000
    assert len(list((tmp_path / "raw").glob("prefixo=*"))) == 256
    batch = registry_rows(spark, 2998, 3003)
    prefixes = {r[0] for r in batch.select(F.substring(parsing.row_hash(batch), 1, 2)).collect()}
    assert spoil_but(tmp_path / "raw", "prefixo", prefixes) > 200
    assert writers.land_registry(batch, out, "2026-07-02 00:00:00") == {"attempted": 5, "inserted": 3}
    log = layout.loads(spark, out).orderBy("ingested_at").collect()
    assert [(r["tentados"], r["inseridos"]) for r in log] == [(3000, 3000), (5, 3)]
    kept = spark.read.schema(schemas.RAW).parquet(out).filter(F.col("prefixo").isin(list(prefixes)))
    ids = [r[0] for r in kept.filter(F.col("ingested_at") > F.lit("2026-07-01 12:00:00").cast("timestamp_ntz")).select("row_id").collect()]
    assert len(ids) == 3 and min(ids) > log[0]["ultimo_id"]


def test_a_landing_lost_after_its_rows_keeps_its_ids(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "raw")
    real = layout.log_load

    def lost(*args):
        if args[-1] is not None:
            raise OSError("lost")
        real(*args)

    monkeypatch.setattr(layout, "log_load", lost)
    with pytest.raises(OSError, match="lost"):
        writers.land_registry(registry_rows(spark, 0, 50), out, "2026-07-01 00:00:00")
    monkeypatch.setattr(layout, "log_load", real)
    assert writers.land_registry(registry_rows(spark, 40, 60), out, "2026-07-02 00:00:00")["inserted"] == 10
    table = readers.landed(spark, out)
    assert table.count() == table.select("row_id").distinct().count() == 60


def test_landed_rows_are_found_by_hash(spark, tmp_path):
    out = str(tmp_path / "raw")
    writers.land_registry(registry_rows(spark, 0, 200), out, "2026-07-01 00:00:00", prefix_chars=1)
    one = readers.landed(spark, out).first()
    assert readers.landed(spark, out).filter(F.col("hash") == one["hash"]).collect() == [one]
    assert writers.land_registry(registry_rows(spark, 0, 0), out, "2026-07-01 00:00:00") == {"attempted": 0, "inserted": 0}


def test_an_upsert_rewrites_the_folders_it_names(spark, tmp_path):
    out, path = str(tmp_path / "plants"), tmp_path / "plants"

    def some(first, last, version, kw):
        return spark.range(first, last).select(
            F.concat(F.lit("CEG"), "id").alias("hash"), F.lit(kw).alias("kw"), F.lit(version).alias("versao")
        )

    writers.write_plants(some(0, 2000, 1, 1.0), out, ["versao"])
    assert len(list(path.glob("balde=*"))) == 64
    before = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    twice = some(1995, 2005, 2, 2.0).unionByName(some(2004, 2005, 3, 3.0))
    changes = writers.write_plants(twice, out, ["versao"])
    assert changes.folders <= 10 and changes.removed.count() == 5 and changes.added.count() == 10
    after = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    assert len([f for f in before if after.get(f) != before[f]]) <= 10
    rows = {r["hash"]: r["kw"] for r in spark.read.parquet(out).collect()}
    assert len(rows) == 2005 and rows["CEG2004"] == 3.0 and rows["CEG1995"] == 2.0 and rows["CEG1994"] == 1.0


def units(spark, first, last, version, uf="SP", kw=1.25):
    return spark.range(first, last).select(
        "id", F.concat(F.lit("h"), "id").alias("hash"), F.lit(uf).alias("siguf"),
        F.when(F.col("id") % 3 == 0, "eol").otherwise("ufv").alias("dscfontegeracao"),
        (F.lit(kw) * F.col("id")).alias("potencia_instalada_kw"), F.lit(version).alias("versao"),
    )


def test_cells_follow_landings_and_replacements(spark, tmp_path):
    out, cells, path = str(tmp_path / "units"), str(tmp_path / "cells"), tmp_path / "units"
    loads = [
        units(spark, 0, 500, 1),
        units(spark, 400, 600, 2, kw=0.1),
        units(spark, 3, 9, 3, "RJ").unionByName(units(spark, 5, 6, 4, None, None)),
        units(spark, 0, 0, 5),
    ]
    for number, rows in enumerate(loads):
        writers.write_units(rows, out, ["versao"], cells, number, buckets=16)
        if number == 1:
            writers.fold_cells(spark, cells)
            spoil(tmp_path / "cells" / "partes")
        whole = capacity.capacity_cells(spark.read.parquet(out)).collect()
        got = writers.maintained_cells(spark, cells).collect()
        assert sorted(((r["siguf"], r["dscfontegeracao"], r["empreendimentos"]) for r in got), key=str) == sorted(
            ((r["siguf"], r["dscfontegeracao"], r["empreendimentos"]) for r in whole), key=str
        )
        assert sum(r["potencia_total_kw"] for r in got) == pytest.approx(sum(r["potencia_total_kw"] or 0 for r in whole))
    with pytest.raises(ValueError, match="already"):
        writers.write_units(loads[0], out, ["versao"], cells, 2)


def test_cells_read_only_the_folders_of_a_load(spark, tmp_path):
    out, cells = str(tmp_path / "units"), str(tmp_path / "cells")
    writers.write_units(units(spark, 0, 1000, 1), out, ["versao"], cells, 0)
    batch = units(spark, 0, 3, 2, "MG")
    named = {str(r[0]) for r in batch.select(F.pmod(F.xxhash64("hash"), F.lit(64))).collect()}
    spoil_but(tmp_path / "units", "balde", named)
    writers.write_units(batch, out, ["versao"], cells, 1)
    got = {(r["siguf"], r["dscfontegeracao"]): r["empreendimentos"] for r in writers.maintained_cells(spark, cells).collect()}
    assert got == {("SP", "eol"): 333, ("SP", "ufv"): 664, ("MG", "eol"): 1, ("MG", "ufv"): 2}


def dispatch_rows(spark, first, last, shift=0):
    day = F.add_months(F.lit("2020-01-15").cast("date"), (F.col("id") % 40).cast("int"))
    return spark.range(first, last, 1, 8).select(
        F.when(F.col("id") % 41 != 40, day).alias("din_programacaodia"),
        F.col("id").cast("int").alias("num_patamar"),
        F.sha2((F.col("id") + shift).cast("string"), 256).alias("hash"),
        F.lit("a.csv").alias("fonte_arquivo"),
    )


def test_dispatch_is_compared_by_month_and_written_in_few_files(spark, tmp_path):
    out, path = str(tmp_path / "dispatch"), tmp_path / "dispatch"
    writers.append_dispatch(dispatch_rows(spark, 0, 4000), out)
    folders = list(path.glob("mes=*"))
    assert len(folders) == 41 and len(list(path.rglob("*.parquet"))) == 41
    days = dispatch_rows(spark, 0, 2).unionByName(dispatch_rows(spark, 0, 2, shift=10**6))
    assert spoil_but(path, "mes", {"2020-01", "2020-02"}) == 39
    writers.append_dispatch(days, out)
    kept = spark.read.schema(schemas.STORED_DISPATCH).parquet(out).filter("mes IN ('2020-01', '2020-02')")
    first_days = dispatch_rows(spark, 0, 4000).filter("din_programacaodia < DATE '2020-03-01'")
    assert kept.count() == first_days.count() + 2


def test_rows_without_a_day_are_compared_too(spark, tmp_path):
    out = str(tmp_path / "dispatch")
    for _ in range(2):
        writers.append_dispatch(dispatch_rows(spark, 40, 41).unionByName(dispatch_rows(spark, 1, 2)), out)
    assert readers.stored(spark, out, schemas.STORED_DISPATCH).count() == 2


def test_dispatch_stored_before_moves_hashes_only(spark, tmp_path, monkeypatch):
    out, kept, real = str(tmp_path / "dispatch"), [], writers.materialise
    monkeypatch.setattr(writers, "materialise", lambda rows, label: kept.append(rows) or real(rows, label))
    texts = [("a" * 64), ("A" * 64), ("b" * 63), ("c" * 32), "", "é ", None]
    rows = spark.createDataFrame(
        [(datetime.date(2020, 1, 2), k % 7, texts[k % 7], f"{k // 7}.csv") for k in range(21)],
        "din_programacaodia date, num_patamar int, hash string, fonte_arquivo string",
    ).filter("hash IS NOT NULL OR fonte_arquivo = '0.csv'")
    for batch in (rows.filter("num_patamar < 4"), rows, rows.filter("hash IS NOT NULL")):
        writers.append_dispatch(batch, out)
    stored = readers.stored(spark, out, schemas.STORED_DISPATCH).select("num_patamar", "hash", "fonte_arquivo")
    assert sorted(map(tuple, stored.collect())) == [(k, text, "0.csv") for k, text in enumerate(texts)]
    # Before, both whole batches were stored on the way.
    assert [r.columns for r in kept] == [["hash"], ["hash"]]
    codec = pq.ParquetFile(next((tmp_path / "dispatch").rglob("*.parquet"))).metadata.row_group(0).column(0).compression
    assert codec == "ZSTD"


def test_dispatch_of_a_large_month_is_cut_by_hash(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "SLOT_ROWS", 20)
    out, rows = str(tmp_path / "dispatch"), dispatch_rows(spark, 0, 4100)
    writers.append_dispatch(rows.unionByName(rows.withColumn("fonte_arquivo", F.lit("b.csv"))), out)
    stored = readers.stored(spark, out, schemas.STORED_DISPATCH)
    assert stored.count() == 4100 and stored.filter("fonte_arquivo <> 'a.csv'").isEmpty()
    slots = layout.slot("mes", "hash", layout.folder_sizes(stored, "mes"))
    assert stored.groupBy("mes").agg(F.count_distinct(slots).alias("n")).filter("n <> 5 AND n <> 6").isEmpty()


def test_compaction_joins_small_files(spark, tmp_path):
    out, path = str(tmp_path / "dispatch"), tmp_path / "dispatch"
    for k in range(3):
        writers.append_dispatch(dispatch_rows(spark, 100 * k, 100 * (k + 1) - 50 * k), out)
    rows = readers.stored(spark, out, schemas.STORED_DISPATCH)
    before = sorted(rows.select("num_patamar", "mes").collect(), key=str)
    assert layout.compact(spark, out, schemas.STORED_DISPATCH, "mes") > 10
    again = readers.stored(spark, out, schemas.STORED_DISPATCH)
    assert sorted(again.select("num_patamar", "mes").collect(), key=str) == before
    assert len(list(path.rglob("*.parquet"))) == len(list(path.glob("mes=*")))
    assert layout.compact(spark, out, schemas.STORED_DISPATCH, "mes") == 0


def test_reports_read_the_logs_of_loads(spark, tmp_path):
    raw_path, fact_path = str(tmp_path / "raw"), str(tmp_path / "fact")
    for day, first in ((1, 0), (2, 50)):
        writers.land_registry(registry_rows(spark, first, first + 100), raw_path, f"2026-07-0{day} 00:00:00")
    writers.land_registry(registry_rows(spark, 0, 100), raw_path, "2026-07-03 00:00:00")
    raw = readers.landed(spark, raw_path)
    fact = registry.lean_fact(raw.filter("row_id % 3 <> 0"))
    writers.write_fact(fact, fact_path, "2026-07-04 00:00:00")
    logged = quality.logged_profile(layout.loads(spark, raw_path), layout.loads(spark, fact_path))
    assert logged.first().asDict() == {
        "mmgd_raw": 150, "mmgd_fato": fact.count(), "mais_recente": datetime.datetime(2026, 7, 2),
    }
    found = quality.registry_findings(logged, fact.columns, "2026-08-20T00:00:00Z").collect()
    alone = quality.report(
        quality.schema_gap(fact), quality.staleness(raw, "2026-08-20T00:00:00Z"), quality.completeness(raw, fact)
    )
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, alone.drop("ordem").collect()), key=str)
    nothing = quality.logged_profile(layout.loads(spark, str(tmp_path / "none")), layout.loads(spark, str(tmp_path / "none")))
    assert nothing.first().asDict() == {"mmgd_raw": 0, "mmgd_fato": 0, "mais_recente": None}


def test_stored_fact_reads_the_folders_asked_for(spark, sf_dir, tmp_path):
    out = str(tmp_path / "fact")
    fact = registry.lean_fact(inputs.raw(spark, sf_dir))
    writers.write_fact(fact, out)
    spoil_but(tmp_path / "fact", "uf_pasta", {"NATION_3", "-"})
    some = readers.stored_fact(spark, out, fact.schema, ["NATION_3", ""])
    assert some.columns == fact.columns
    assert some.count() == fact.filter("siguf IN ('NATION_3', '')").count()


def test_load_append_repeats(spark, tmp_path):
    (tmp_path / "S.json").write_text(json.dumps([{"cod_areacarga": "S", "din_referenciautc": "2026-07-10T00:30:00Z", "val_cargaglobal": 5.5}]))
    records = readers.recent_load(spark, str(tmp_path / "S.json"), "2026-07-10", 1)
    out = str(tmp_path / "load")
    for day in (1, 2):
        writers.append_load(records, out, f"2026-07-1{day} 00:00:00")
    stored = readers.stored(spark, out, schemas.STORED_LOAD)
    points = stored.collect()
    assert points[0]["carga_global"] == 5.5 and json.loads(points[0]["data_json"])["cod_areacarga"] == "S"
    day = load.load_series(stored, "S", "2026-07-10", "2026-07-11")
    assert "PartitionFilters: [isnotnull(dia" in day._jdf.queryExecution().executedPlan().toString()
    assert day.count() == 2
    assert len(points) == 2 and len({p["id"] for p in points}) == 2
    assert {(p["area"], p["tipo"], str(p["ts"]), p["val"]) for p in points} == {("S", "verificada", "2026-07-10 00:30:00", 5.5)}


def test_treemap_document(spark, tmp_path):
    rows = [
        ("SP", "UFV", 2000.0, 0), ("SP", "EOL", 3000.0, 0), ("SP", "CGH", 0.2, 0), ("RJ", "UFV", 0.1, 0),
        ("", "UFV", 900.0, 0), (None, "UFV", 900.0, 0), ("MG", "UFV", 9000.0, 1),
    ]
    df = spark.createDataFrame(rows, "uf string, fonte_norm string, potencia_kw double, is_outlier int")
    out = str(tmp_path / "tree")
    writers.write_treemap(df, out, "2026-07-14T00:00:00")
    region = json.loads(text_of(out))
    assert (region["root"], region["unit"], region["name"]) == ("Brasil", "MW", "SP")
    assert region["value"] == 5.0 and region["qtd"] == 3
    assert [(c["name"], c["value"]) for c in region["children"]] == [("EOL", 3.0), ("UFV", 2.0)]


def test_geojson_lines(spark, sf_dir, tmp_path):
    out = str(tmp_path / "geo")
    writers.write_geojson(inputs.plants(spark, sf_dir), out, 7)
    features = [json.loads(line) for line in text_of(out).splitlines()]
    assert len(features) == 7
    first = features[0]
    assert first["type"] == "Feature"
    assert first["geometry"]["coordinates"] == [first["properties"]["lon"], first["properties"]["lat"]]


def test_report_files(spark, tmp_path):
    missing = quality.missing_areas(spark.createDataFrame([("S",)], "area string"), ["S", "NE"])
    out = str(tmp_path / "report")
    assert writers.write_report(quality.report(missing), out, "2026-07-14T11:58:54") is False
    assert json.loads(text_of(f"{out}/divergencias"))["chave"] == "NE"
    resumo = json.loads(text_of(f"{out}/resumo"))
    assert (resumo["total_divergencias"], resumo["criticos"], resumo["atencoes"]) == (1, 0, 1)


def test_growth_snapshot_is_replaced_by_date(spark, sf_dir, tmp_path):
    fact, plants, points = (
        catalog.dated_fact(spark, sf_dir), inputs.plants(spark, sf_dir), catalog.points(spark, sf_dir),
    )
    out = str(tmp_path / "growth")
    for day in ("1996-12-31", "1997-12-31", "1997-12-31"):
        writers.write_snapshot_row(growth.snapshot(fact, plants, points, day), out)
    log = growth.recent(spark.read.parquet(out)).collect()
    assert [str(r["data"]) for r in log] == ["1997-12-31", "1996-12-31"]
    assert log[0]["mmgd_ativos"] > log[1]["mmgd_ativos"]


def test_fact_snapshot_prunes_by_uf(spark, sf_dir, tmp_path):
    out = str(tmp_path / "fact")
    fact = registry.lean_fact(inputs.raw(spark, sf_dir))
    writers.write_fact(fact, out)
    stored = spark.read.parquet(out).filter(F.col("uf_pasta") == "NATION_3")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(uf_pasta" in plan
    assert stored.count() == fact.filter(F.col("siguf") == "NATION_3").count()
    unnamed = fact.filter("siguf = ''").count()
    assert unnamed > 0 and spark.read.parquet(out).filter("siguf = ''").count() == unnamed


def test_cells_serve_every_level(spark, sf_dir, tmp_path):
    out = str(tmp_path / "cells")
    fact = registry.lean_fact(inputs.raw(spark, sf_dir))
    writers.write_cells(fact, out)
    levels = capacity.treemap_levels(spark.read.parquet(out))
    for level, keys in {"uf": ["uf"], "fonte": ["fonte"], "uf_fonte": ["uf", "fonte"]}.items():
        one = capacity.treemap(spark.read.parquet(out), level).select(*keys, "empreendimentos")
        same = levels.filter(F.col("nivel") == level).select(*keys, "empreendimentos")
        assert sorted(one.collect()) == sorted(same.collect())


def test_packed_hashes_of_odd_texts(spark):
    plain = "0123456789abcdef" * 4
    texts = [plain, plain + "\n", plain.upper(), plain[:-1] + "g", plain[:-2] + "é", plain[:-1], "", " ", None]
    packed = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parsing.packed_hash(F.col("t")).alias("p"))
    rows = packed.select("t", "p", parsing.unpacked_hash(F.col("p")).alias("u")).collect()
    assert all(r["t"] == r["u"] for r in rows)
    assert len({r["p"] and bytes(r["p"]) for r in rows}) == len(texts) and [len(r["p"]) for r in rows if r["t"] == plain] == [32]


def test_first_rows_of_dealt_keys_come_in_the_order_of_their_folders(spark):
    dealt = spark.range(1000).selectExpr("id % 3 AS mes", "id % 2 AS slot", "id % 7 AS hash", "id AS f").repartition("mes", "slot")
    first = rowsets.keep_first(dealt, "hash", ["f"], ("mes", "slot")).sortWithinPartitions("mes")
    plan = first._jdf.queryExecution().executedPlan()
    assert first.count() == 42
    assert first.select("mes")._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert plan.toString().count("Sort [") == 1
