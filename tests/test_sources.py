import json

import pytest

from gridspark.operators import plants
from gridspark.sources import readers

HEADER = "CodEmpreendimento;MdaPotenciaInstaladaKW;SigUF;DscFonteGeracao"


def test_registry_snapshot_is_latin1_text(spark, tmp_path):
    lines = [HEADER, 'U-1;"407,25";GO;Biogás', "U-2;9,90;PA;Cinética do vento (eólica)"]
    (tmp_path / "a.csv").write_bytes("\n".join(lines).encode("latin-1"))
    df = readers.registry_snapshot(spark, str(tmp_path))
    rows = df.orderBy("CodEmpreendimento").collect()
    assert [r["MdaPotenciaInstaladaKW"] for r in rows] == ["407,25", "9,90"]
    assert rows[0]["DscFonteGeracao"] == "Biogás"
    assert readers.field_list(df)[0] == {"id": "CodEmpreendimento", "type": "text"}
    assert readers.registry_snapshot(spark, str(tmp_path), 1).count() == 1


def test_plant_pages(spark, tmp_path):
    def page(name, records):
        (tmp_path / name).write_text(json.dumps({"success": True, "result": {"total": 3, "records": records}}))

    page("0.json", [
        {"_id": 1, "CodCEG": "C1", "NomEmpreendimento": "A", "MdaPotenciaOutorgadaKw": "1200,5"},
        {"_id": 2, "CodCEG": "", "NomEmpreendimento": "B", "MdaPotenciaOutorgadaKw": ""},
    ])
    page("1.json", [{"_id": 3, "CodCEG": "C3", "MdaPotenciaOutorgadaKw": "1.200,50", "NumCoordNEmpreendimento": "-9,5"}])
    pages = readers.plant_pages(spark, str(tmp_path))
    assert readers.page_completeness(pages).first().asDict() == {"anunciados": 3, "recebidos": 3, "completo": True}
    records = readers.plant_records(pages)
    table = {r["cod_ceg"]: r for r in plants.normalise(records).collect()}
    assert table["C1"]["potencia_outorgada_kw"] == 1200.5 and table["C1"]["hash"] == "C1"
    assert table[""]["potencia_outorgada_kw"] == 0.0 and len(table[""]["hash"]) == 64
    assert table["C3"]["potencia_outorgada_kw"] is None and table["C3"]["lat"] == -9.5
    assert table["C3"]["nome_empreendimento"] == ""
    assert [r["CodCEG"] for r in plants.quarantine(records).collect()] == ["C3"]


def load_file(folder, area, *points):
    records = [
        {"cod_areacarga": area, "dat_referencia": day, "val_cargaglobal": value, "val_cargammgd": 0.0}
        for day, value in points
    ]
    (folder / f"{area}.json").write_text(json.dumps(records))


def test_load_records(spark, tmp_path):
    for area in readers.AREAS:
        load_file(tmp_path, area, ("2031-02-27", 640.5), ("2031-02-28", 702.25))
    (tmp_path / "bad.json").write_text(json.dumps({"error": "no data"}))
    both = readers.recent_load(spark, str(tmp_path), "2031-02-28", 1)
    assert both.count() == 8
    assert {(r["_fonte"], r["_area"]) for r in both.collect()} == {("verificada", a) for a in readers.AREAS}
    assert readers.load_records(spark, str(tmp_path), "2031-02-28", "2031-02-28", ["S"]).count() == 1
    planned = readers.load_records(spark, str(tmp_path), "2031-02-27", "2031-02-28", ["N"], readers.PLANNED)
    assert planned.first()["_fonte"] == "programada"
    with pytest.raises(ValueError):
        readers.load_records(spark, "/nowhere", "2031-02-27", "2031-02-28", ["XX"])


def test_load_area_comes_from_the_folder(spark, tmp_path):
    for folder, record in (("NE", {"val_carga": 1.5}), ("S", {"cod_areacarga": "N", "val_carga": 2.5})):
        (tmp_path / folder).mkdir()
        record["din_referenciautc"] = "2031-02-27T01:00:00Z"
        (tmp_path / folder / "a.json").write_text(json.dumps([record]))
    rows = readers.recent_load(spark, f"{tmp_path}/*", "2031-02-28")
    assert {(r["_area"], r["val_carga"]) for r in rows.collect()} == {("NE", "1.5"), ("S", "2.5")}


def test_dispatch_headers_differ(spark, tmp_path):
    assert readers.dispatch_files(spark, str(tmp_path)).count() == 0
    (tmp_path / "a.csv").write_text("din_programacaodia;num_patamar;val_demanda\n2025-05-01;1;10\n")
    (tmp_path / "b.csv").write_text("val_demanda;cod_subsistema;din_programacaodia\n20;S;2025-05-02\n")
    (tmp_path / "empty.csv").write_text("")
    rows = readers.dispatch_files(spark, str(tmp_path)).orderBy("fonte_arquivo").collect()
    assert [(r["num_patamar"], r["cod_subsistema"], r["val_demanda"]) for r in rows] == [(1, None, 10.0), (None, "S", 20.0)]


def test_dispatch_files(spark, tmp_path):
    head = "din_programacaodia;num_patamar;cod_subsistema;val_demanda;val_gereolica;val_ger_eolica"
    for day in (1, 2):
        (tmp_path / f"d{day}.csv").write_text(f"{head}\n2025-05-0{day};1;S;1234.5;;7.25\n", encoding="utf-8")
    rows = readers.dispatch_files(spark, str(tmp_path)).orderBy("din_programacaodia").collect()
    assert [r["fonte_arquivo"] for r in rows] == ["d1.csv", "d2.csv"]
    assert (rows[0]["num_patamar"], rows[0]["val_demanda"], rows[0]["val_ger_eolica"]) == (1, 1234.5, 7.25)
    assert rows[0]["val_ger_pch"] is None and rows[0]["hash"] != rows[1]["hash"]


def catalogue_file(folder, success=True, resources=()):
    path = folder / "package.json"
    path.write_text(json.dumps({"success": success, "result": {"metadata_modified": "2026-01-01T00:00:00", "resources": list(resources)}}))
    return str(path)


def test_catalogue(spark, tmp_path):
    path = catalogue_file(tmp_path, resources=[
        {"name": "notes.csv", "format": "CSV", "url": "u0"},
        {"name": "Test.ZIP", "format": "file", "url": "u1"},
        {"name": "other", "format": "zip", "url": ""},
        {"name": "late", "format": "ZIP", "url": "u3"},
    ])
    answer = readers.catalogue(spark, path)
    assert [r["url"] for r in readers.csv_resources(answer).collect()] == ["u0"]
    assert readers.zip_by_name(answer).first()["url"] == "u1"
    assert readers.zip_by_format(answer).first()["url"] == "u3"
    empty = readers.catalogue(spark, catalogue_file(tmp_path))
    assert readers.zip_by_name(empty).count() == 0
    with pytest.raises(RuntimeError):
        readers.catalogue(spark, catalogue_file(tmp_path, success=False))


def test_headers_are_the_first_line_of_each_file(spark, tmp_path):
    for n in range(40):
        body = "".join(f"{n};{i}\n" for i in range(n % 5 * 3000))
        (tmp_path / f"f{n:02}.csv").write_text(f"﻿head{n % 3};x\n{body}")
    lines = spark.read.text(str(tmp_path)).selectExpr(
        "value", "_metadata.file_path AS file", "_metadata.file_block_start AS start"
    )
    headers = readers._headers(lines)
    found = {r.file.rsplit("/", 1)[1]: r.header for r in headers.collect()}
    assert found == {f"f{n:02}.csv": f"head{n % 3};x" for n in range(40)}
    plan = headers._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan


def test_dispatch_lines_are_parsed_once_for_what_is_taken(spark, tmp_path):
    (tmp_path / "a.csv").write_text("din_programacaodia;num_patamar\n2025-05-01;1\n2025-06-01;x\n")
    (tmp_path / "b.csv").write_text("﻿num_patamar;din_programacaodia\n2;2025-05-02\n")
    rows = readers.dispatch_files(spark, str(tmp_path))
    days = rows.filter("din_programacaodia < DATE'2025-06-01'").select("din_programacaodia")
    plan = days._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan and "sha2" not in plan
    assert plan.count("from_csv") == 2 and "lambda" not in plan
    assert sorted(str(r[0]) for r in days.collect()) == ["2025-05-01", "2025-05-02"]
    assert [r["num_patamar"] for r in rows.orderBy("din_programacaodia").collect()] == [1, 2, None]
    assert len({r["hash"] for r in rows.collect()}) == 3
