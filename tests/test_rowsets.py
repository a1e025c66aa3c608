import random

from pyspark.sql import functions as F

from gridspark.operators import registry, rowsets


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id bigint, hash string, v string")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_keep_first_keeps_every_null_key(spark):
    df = rows(spark, (3, "a", "x"), (1, "a", "y"), (2, None, "p"), (4, None, "q"), (5, "", "r"), (6, "", "s"))
    assert ids(rowsets.keep_first(df, "hash", ["id"])) == [1, 2, 4, 5]


def test_keep_last_merges_null_keys(spark):
    df = rows(spark, (3, "a", "x"), (1, "a", "y"), (2, None, "p"), (4, None, "q"))
    assert ids(rowsets.keep_last(df, ["hash"], ["id"])) == [3, 4]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select("id", F.concat(F.lit("h"), F.col("id") % 2).alias("hash"))
    plan = plan_of(rowsets.keep_first(df, "hash", ["id"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_insert_twice_adds_nothing(spark):
    stored = rows(spark, (1, "a", "old"))
    incoming = rows(spark, (2, "a", "new"), (3, "b", "new"), (4, "b", "later"), (5, None, "n"))
    once = rowsets.insert_or_ignore(stored, incoming, "hash", ["id"])
    assert ids(once) == [1, 3, 5]
    assert ids(rowsets.new_rows(once, incoming.filter("hash is not null"), "hash", ["id"])) == []


def test_upsert_last_write_wins(spark):
    stored = rows(spark, (1, "a", "old"), (2, "c", "kept"))
    incoming = rows(spark, (5, "a", "first"), (6, "a", "second"), (7, "b", "new"))
    result = rowsets.upsert(stored, incoming, F.col("hash"), ["id"])
    assert {r["hash"]: r["v"] for r in result.collect()} == {"a": "second", "b": "new", "c": "kept"}
    again = rowsets.upsert(result, incoming, F.col("hash"), ["id"])
    assert sorted(again.collect()) == sorted(result.collect())


def test_dense_ids_of_sparse_keys(spark):
    evaluated = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            evaluated.add(batch.num_rows)
            yield batch

    keys = [(10**6 * k * (-1) ** k,) for k in range(3000)]
    df = spark.createDataFrame(keys, "k bigint").repartition(5).mapInArrow(seen, "k bigint")
    rows = rowsets.dense_ids(df, "k")
    got = {r["k"]: r["id"] for r in rows.collect()}
    assert [k for k, _ in sorted(got.items(), key=lambda x: x[1])] == sorted(k for k, in keys)
    assert sorted(got.values()) == list(range(1, 3001))
    assert evaluated.value == 3000
    windows = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line]
    assert len(windows) == 1 and "__n" in windows[0]


def test_dense_ids_of_nothing(spark):
    assert rowsets.dense_ids(spark.createDataFrame([], "k bigint"), "k").collect() == []


def test_dense_ids(spark):
    keys = random.Random(1).sample(range(-500, 5000), 700)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = {r["k"]: r["id"] for r in rowsets.dense_ids(df, "k", start=10).collect()}
    assert got == {k: i + 10 for i, k in enumerate(sorted(keys))}


RAW = "row_id bigint, hash string, raw_json string"


def raw(spark, *docs):
    return spark.createDataFrame(list(docs), RAW)


def test_lean_fact_reads_loosely(spark):
    df = raw(
        spark,
        (1, "a", '{"CodEmpreendimento":"GD.1","SigUF":"SP","DscFonteGeracao":"EÓLICA","MdaPotenciaInstaladaKW":"1.200.50"}'),
        (2, "b", '{"SigUF":"RJ"}'),
        (3, "c", "not json"),
        (4, "d", None),
        (5, "e", '{"SigUF":"AC","MdaPotenciaInstaladaKW":"75,01"}'),
        (6, "f", '{"SigUF":"AC","MdaPotenciaInstaladaKW":"5000,5"}'),
    )
    got = {r["id"]: r for r in registry.lean_fact(df).collect()}
    assert len(got) == 6
    assert (got[1]["dscfontegeracao"], got[1]["potencia_instalada_kw"]) == ("eólica", 1.2)
    assert (got[2]["potencia_instalada_kw"], got[2]["faixa_regulatoria"]) == (0.0, "microgeracao")
    assert got[3]["siguf"] is None and got[4]["siguf"] is None
    assert got[5]["faixa_regulatoria"] == "minigeracao" and got[6]["faixa_regulatoria"] == "geracao"
    assert ids(registry.valid_only(registry.lean_fact(df)).withColumnRenamed("id", "id")) == [1, 2, 5, 6]


def test_incremental_fact_twice(spark):
    df = raw(spark, *[(i, f"h{i // 2}", f'{{"SigUF":"U{i}"}}') for i in range(1, 9)])
    stored = rowsets.keep_first(registry.lean_fact(df.filter("row_id <= 4")), "hash", ["id"])
    added = registry.incremental_fact(df, stored)
    assert ids(added) == [6, 8]
    full = stored.unionByName(added)
    assert registry.incremental_fact(df, full).count() == 0
    assert registry.load_counts(df, stored, added).first().asDict() == {
        "total_raw": 8, "fato_antes": 3, "fato_depois": 5, "novos": 2,
    }


def test_incremental_fact_on_an_empty_fact(spark):
    df = raw(spark, (1, "a", '{"SigUF":"SP"}'))
    empty = registry.lean_fact(df).filter(F.lit(False))
    assert ids(registry.incremental_fact(df, empty)) == [1]


def test_enrich_fills_only_open_rows(spark):
    df = raw(spark, (1, "a", '{"NomMunicipio":"X","SigAgente":null}'), (2, "b", '{"NomMunicipio":"Y"}'))
    fact = registry.enrich(registry.lean_fact(df), df)
    assert {r["id"]: (r["municipio"], r["distribuidora"], r["qtd_uc_recebe_credito"]) for r in fact.collect()} == {
        1: ("X", "", 0), 2: ("Y", "", 0),
    }
    open_one = fact.withColumn("municipio", F.when(F.col("id") == 1, "kept")).unionByName(
        fact.filter("id = 1").withColumns({"id": F.lit(9).cast("bigint"), "hash": F.lit(None).cast("string"), "municipio": F.lit(None).cast("string")})
    )
    again = {r["id"]: r["municipio"] for r in registry.enrich(open_one, df).collect()}
    assert again == {1: "kept", 2: "Y", 9: None}
