import collections

import duckdb
import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from gridspark.llm import oracles, queries
from gridspark.session import materialise
from tests.llm import helpers, test_near_dedup, test_token_ops


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_match_brute_force(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    columns = docs.columns
    kept = {r.doc_id for r in queries.op4_quality(spark, sf_dir).filter("predicted = 1").collect()}
    labels = {r.doc_id: r.quality for r in queries.table(spark, sf_dir, "labels").collect()}
    assert len(kept & {d for d, q in labels.items() if q == 1}) > 0.95 * sum(labels.values())
    want = [r for r in rows(docs) if r[0] in kept]
    docs = step(spark, docs, sf_dir, 0, columns)
    assert rows(docs) == want

    first = {}
    for r in sorted(want):
        first.setdefault(collapsed(r[1]), r)
    want = sorted(first.values(), key=str)
    docs = step(spark, docs, sf_dir, 1, columns)
    assert rows(docs) == want

    named = {i: c for i, c, _ in test_near_dedup.expected(want)}
    want = [r for r in want if named[r[0]] == r[0]]
    docs = step(spark, docs, sf_dir, 2, columns)
    assert rows(docs) == want

    con = duckdb.connect()
    con.register("left_docs", pd.DataFrame(want, columns=columns))
    taken = con.execute(
        "WITH " + oracles.MIX_STEPS.format(documents="left_docs") + "SELECT doc_id, copies FROM mixed"
    ).fetchall()
    copies = dict(taken)
    want = [r for r in want for _ in range(copies[r[0]])]
    docs = step(spark, docs, sf_dir, 3, columns)
    assert rows(docs) == want

    got = [tuple(r) for r in corpus_pipeline.STAGES[4][1](spark, docs, sf_dir).collect()]
    assert test_token_ops.check_packing(got, want) < 1.05
    assert rows(corpus_pipeline.run(spark, sf_dir)) == sorted(got, key=str)


def collapsed(text):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def step(spark, docs, sf_dir, number, columns):
    out = materialise(corpus_pipeline.STAGES[number][1](spark, docs, sf_dir), "pipeline-test")
    assert out.columns == columns
    return out


def test_stages_take_awkward_and_empty_tables(spark, sf_dir):
    docs = helpers.documents(spark)
    for number in range(4):
        docs = step(spark, docs, sf_dir, number, docs.columns)
    empty = helpers.documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_stages_hand_on_columns_of_any_name(spark, sf_dir):
    names = ["gone", "_gone", "odd", "_id", "row", "copies", "size", "key", "place", "quality", "label_id", "digest", "copy"]
    docs = helpers.documents(spark).drop("size", "hash").withColumns({n: F.lit(n) for n in names})
    for number in range(4):
        docs = step(spark, docs, sf_dir, number, docs.columns)
        assert docs.filter(F.col("row") != "row").isEmpty()
    assert corpus_pipeline.STAGES[4][1](spark, docs, sf_dir).count() > 0


def test_repeated_rows_and_ids(spark, sf_dir):
    data = [(1, "a b", "en", "s"), (1, "a b", "en", "s"), (1, "other", "en", "s"), (2, "a  b", "en", "s"), (None, "a b", "en", "s"), (None, "x", "en", "s")]
    out = corpus_pipeline.without_copies(spark, helpers.documents(spark, data), sf_dir)
    got = collections.Counter((r.doc_id, r.text) for r in out.collect())
    assert got == collections.Counter([(1, "a b"), (1, "other"), (None, "x")])
