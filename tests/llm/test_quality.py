import math
import zlib

import numpy as np
import pytest
import regex

from gridspark.llm import quality, queries
from tests.llm import helpers


def auc(score, label):
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(score))
    ranks[order] = np.arange(1, len(score) + 1)
    for value in np.unique(score):  # ties share their mean rank
        same = score == value
        ranks[same] = ranks[same].mean()
    good = label == 1
    return (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_held_out_documents_are_ranked(spark, sf_dir):
    scored = queries.op4_quality(spark, sf_dir)
    rows = scored.join(queries.table(spark, sf_dir, "labels"), "doc_id").filter("held_out").toPandas()
    assert ((scored.count()) == queries.table(spark, sf_dir, "documents").count())
    assert auc(rows.score.to_numpy(), rows.quality.to_numpy()) > 0.97
    assert (rows.predicted == rows.quality).mean() > 0.93
    assert (rows[rows.quality == 1].predicted == 1).mean() > 0.95


def test_awkward_rows_have_scores(spark):
    docs = helpers.documents(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (3, 0, 0), (3, 1, 0), (9, None, 0), (None, 1, 1), (77, 0, 0)], "doc_id bigint, quality int, toxic int"
    )
    ranking = quality.fit(docs, labels)
    rows = quality.scored(docs, ranking).collect()
    assert len(rows) == len(helpers.ROWS)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert quality.scored(docs.limit(0), ranking).count() == 0
    one_sided = quality.fit(docs, labels.filter("quality = 1"))
    assert {r.predicted for r in quality.scored(docs, one_sided).collect()} == {1}


def plain_features(text):
    """The features again, in Python."""
    text = text or ""
    chars, tokens = max(1, len(text)), text.lower().split(" ")

    def share(pattern):
        return len(regex.findall(pattern, text)) / chars

    upper, symbols = share(r"\p{Lu}"), share(r"[^\p{L}\p{N}\s.,;:'!?|-]")
    return [
        upper, min(upper * 3, 1), symbols, symbols**0.5, share("!") ** 0.5, share(r"\|") ** 0.5, share("[.?]") ** 0.5,
        share(r"\p{N}") ** 0.5, math.log(len(set(tokens)) + 1) / math.log(len(tokens) + 1), len(set(tokens)) / len(tokens),
        chars / len(tokens) / 50, math.log(chars) / 12, share("\n") ** 0.5,
    ]


def test_scores_equal_brute_force(spark, sf_dir):
    """Fit and scores by numpy and gradient descent over all pairs used, without the library's solver."""
    docs = [tuple(r) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    labels = {r.doc_id: r.quality for r in queries.table(spark, sf_dir, "labels").collect()}
    table = {i: np.array(plain_features(t)) for i, t in docs}
    taught = [i for i in labels if i in table and zlib.crc32(str(i).encode()) % 5 != 0]
    order = sorted(taught, key=lambda i: (labels[i], *reversed(table[i])))
    x, y = np.array([table[i] for i in order]), np.array([labels[i] for i in order])
    spread = x.std(axis=0)
    spread[spread < 1e-9] = 1
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y != 1)
    loser = np.repeat(bad, min(24, len(good)))
    pairs = (x[good[(np.arange(len(loser)) * 7919) % len(good)]] - x[loser]) / spread
    solved = minimize(pairs, 1e-3)
    strength = np.sort(x / spread @ solved)
    cut = (strength[len(bad) - 1] + strength[len(bad)]) / 2
    got = {r.doc_id: r for r in queries.op4_quality(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for i, _ in docs:
        want = 1 / (1 + math.exp(-(table[i] / spread @ solved - cut + math.log(0.3 / 0.7))))
        assert got[i].score == pytest.approx(want, abs=1e-4)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)


def minimize(pairs, penalty):
    """Weights at which the slope of the penalised logistic loss vanishes, by accelerated descent."""
    rate = 1 / (np.linalg.norm(pairs, 2) ** 2 / (4 * len(pairs)) + penalty)
    w = last = np.zeros(pairs.shape[1])
    for k in range(200_000):
        ahead = w + k / (k + 3) * (w - last)
        slope = -(pairs.T @ (1 / (1 + np.exp(np.clip(pairs @ ahead, -500, 500))))) / len(pairs) + penalty * ahead
        if np.abs(slope).max() < 1e-10:
            break
        last, w = w, ahead - rate * slope
    return w


def test_one_id_in_very_many_rows_is_one_example(spark, monkeypatch):
    sizes = []
    real = quality.rank
    monkeypatch.setattr(quality, "rank", lambda table, *rest: sizes.append(len(table)) or real(table, *rest))
    docs = spark.range(2000).selectExpr("id % 2 + 1 AS doc_id", "concat('text ', id) AS text")
    quality.fit(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int"))
    assert sizes == [2 - sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in (1, 2))]


def test_pairs_recover_an_order():
    rng = np.random.default_rng(5)
    table = rng.normal(size=(4000, 3))
    label = (table @ [2.0, -1.0, 0.0] + rng.logistic(size=4000) > 1).astype(int)
    found = quality.rank(table, label, ["a", "b", "c"])
    assert found.weights["a"] > 0 > found.weights["b"]
    assert found.weights["a"] / -found.weights["b"] == pytest.approx(2, rel=0.3)
    assert abs(found.weights["c"]) < 0.2


def made(spark, good, bad):
    """Labelled documents that marks tell apart, though not all of them."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(good + bad):
        kind = int(i < good)
        words = ["word" + "!" * int(rng.random() < (0.1 if kind else 0.3)) for _ in range(20 + int(rng.integers(30)))]
        rows.append((i, " ".join(words), kind))
    return spark.createDataFrame(rows, "doc_id bigint, text string, quality int")


@pytest.mark.parametrize("good, bad", [(900, 400), (3, 700), (700, 2)])
def test_blocks_learn_from_every_label(spark, good, bad):
    docs = made(spark, good, bad)
    ranking = quality.fit(docs, docs, 50)
    again = quality.fit(docs.repartition(7), docs, 50)
    assert ranking == again
    taught = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 != 0]
    table = np.array([plain_features(r.text) for r in taught])
    labels = np.array([r.quality for r in taught])
    strength = table @ np.array(list(ranking.weights.values()))
    assert (strength < ranking.cut - 1e-9).sum() <= (labels == 0).sum() <= (strength < ranking.cut + 1e-9).sum()
    whole = quality.fit(docs, docs, 10_000)
    if min(good, bad) > 100:
        assert np.corrcoef(strength, table @ np.array(list(whole.weights.values())))[0, 1] > 0.99
        assert auc(strength, labels) > 0.95


def test_blocks_hold_every_row_and_both_sides(spark):
    names = list(quality.features(quality.F.col("text")))
    for good, bad, n in ((900, 400, 13), (5, 700, 9), (700, 2, 9)):
        rows = quality._examples(*[made(spark, good, bad)] * 2)
        sides = [r[0] for r in rows.select("good").collect()]
        blocks = quality._blocks(rows, sum(sides), len(sides) - sum(sides), names, n).collect()
        assert len(blocks) == n
        assert {tuple(m) for b in blocks for m in b.members} == {tuple(r) for r in rows.select("good", *names).collect()}
        assert all({m.good for m in b.members} == {True, False} for b in blocks)


def test_first_text_of_a_repeated_id_is_learnt_from(spark):
    docs = spark.createDataFrame([(1, "zz!"), (1, "aa"), (2, "b")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1) for i in (1, 2)], "doc_id bigint, quality int")
    rows = quality._examples(docs, labels).collect()
    wanted = {i for i in (1, 2) if zlib.crc32(str(i).encode()) % 5 != 0}
    assert {r.label_id for r in rows} == wanted and all(r.marks == 0 for r in rows)
