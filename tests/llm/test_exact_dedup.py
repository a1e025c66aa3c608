import collections
import hashlib
import re

from pyspark.sql import functions as F

from gridspark.llm import exact_dedup
from tests.llm import helpers


def expected(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    ids = collections.defaultdict(list)
    for row, text in zip(rows, norm):
        ids[text].append(row[0])
    out = []
    for row, text in zip(rows, norm):
        keep = min((i for i in ids[text] if i is not None), default=None)
        kept = row[0] == keep
        out.append((row[0], keep, len(ids[text]), kept, hashlib.sha256(text.encode()).hexdigest()))
    return collections.Counter(out)


def test_awkward_rows(spark):
    got = exact_dedup.decisions(helpers.documents(spark)).collect()
    assert collections.Counter(map(tuple, got)) == expected(helpers.ROWS)
    assert exact_dedup.decisions(helpers.documents(spark).limit(0)).count() == 0


def test_colliding_hashes_are_told_apart(spark):
    got = exact_dedup.decisions(helpers.documents(spark), content_hash=lambda t: F.length(t) % 2).collect()
    assert collections.Counter(map(tuple, got)) == expected(helpers.ROWS)


def test_columns_named_as_those_inside(spark):
    names = ["gone", "odd", "_gone", "_odd", "_sha", "_id", "id", "sha", "row", "doc_id_", "hash", "norm", "keep_id", "kept"]
    rows = [(1, "a  b"), (1, "a b"), (2, "a b"), (None, "a b"), (None, "x"), (3, "y")]
    docs = spark.createDataFrame(
        [(i, t, *[f"{n}{k}" for n in names]) for k, (i, t) in enumerate(rows)],
        ", ".join(["doc_id bigint", "text string", *[f"{n} string" for n in names]]),
    )
    for table in (docs, docs.filter("doc_id IS NOT NULL AND text <> 'a b'")):
        got = exact_dedup.deduplicate(table)
        assert got.columns == docs.columns
        kept = collections.Counter(re.sub(r"\s+", " ", r["text"]) for r in got.collect())
        assert kept == collections.Counter({re.sub(r"\s+", " ", r["text"]) for r in table.collect()})
        assert all(r["row"][3:] == r["gone"][4:] for r in got.collect())
