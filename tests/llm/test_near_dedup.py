import collections
import random

import numpy as np
import pyarrow as pa

from gridspark.llm import near_dedup, queries
from tests.llm import helpers


def shingle_set(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def expected(rows):
    """Class id by row, from all pairs of sets that share a shingle."""
    sets = list({shingle_set(r[1]) for r in rows})
    number = {s: k for k, s in enumerate(sets)}
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for item in s:
            holders[item].append(k)
    common = collections.Counter()
    for ks in holders.values():
        common.update((a, b) for i, a in enumerate(ks) for b in ks[i + 1 :])
    for (a, b), both in common.items():
        if both / (len(sets[a]) + len(sets[b]) - both) >= 0.8:
            parent[root(a)] = root(b)
    ids = collections.defaultdict(list)
    for r in rows:
        ids[root(number[shingle_set(r[1])])].append(r[0])
    return collections.Counter(
        (r[0], min((i for i in ids[k] if i is not None), default=None), len(ids[k]))
        for r in rows
        for k in [root(number[shingle_set(r[1])])]
    )


def test_awkward_rows(spark):
    got = near_dedup.classes(helpers.documents(spark)).drop("kept")
    assert collections.Counter(tuple(r) for r in got.collect()) == expected(helpers.ROWS)
    assert near_dedup.classes(helpers.documents(spark).limit(0)).count() == 0
    assert near_dedup.keep_one(helpers.documents(spark)).columns == helpers.documents(spark).columns


def test_large_group_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(4000)}" for _ in range(160)]
    rows = [(k, " ".join(f"w{rng.randrange(4000)}" for _ in range(80)), "en", "a") for k in range(1000, 1040)]
    for k in range(700):
        words = list(base)
        for _ in range(rng.randrange(1, 6)):
            words[rng.randrange(len(words))] = f"x{k}y{rng.randrange(9)}"
        rows.append((k, " ".join(words), "en", "a"))
    got = near_dedup.classes(helpers.documents(spark, rows)).drop("kept")
    assert collections.Counter(tuple(r) for r in got.collect()) == expected(rows)


def test_op9_matches_brute_force(spark, sf_dir):
    rows = helpers.rows(queries.table(spark, sf_dir, "documents").select("doc_id", "text"))
    got = queries.op9_near_dedup(spark, sf_dir).drop("kept")
    assert collections.Counter(tuple(r) for r in got.collect()) == expected(rows)


def similar_pairs(rows):
    """Pairs of different texts with a similarity of 0.8 or more, by brute force."""
    sets = {}
    for r in rows:
        sets.setdefault(shingle_set(r[1]), r[0])
    holders = collections.defaultdict(list)
    for s in sets:
        for item in s:
            holders[item].append(s)
    common = collections.Counter()
    for held in holders.values():
        common.update((sets[a], sets[b]) for i, a in enumerate(held) for b in held[i + 1 :])
    size = {i: len(s) for s, i in sets.items()}
    return [(a, b) for (a, b), n in common.items() if n / (size[a] + size[b] - n) >= 0.8]


def test_every_similar_pair_is_in_one_class(spark):
    """Recall with and without the filter by signatures, on copies edited to all degrees."""
    rng = random.Random(11)
    rows = []
    for group in range(60):
        base = [f"g{group}w{rng.randrange(4000)}" for _ in range(rng.randrange(40, 200))]
        for k in range(8):
            words = list(base)
            for _ in range(k):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(words), "en", "a"))
    pairs = similar_pairs(rows)
    assert len(pairs) > 200
    docs = helpers.documents(spark, rows)
    for estimate in (near_dedup.ESTIMATE, None):
        named = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs, estimate).collect()}
        assert all(named[a] == named[b] for a, b in pairs)


def test_columns_named_as_those_inside(spark):
    names = ["gone", "_gone", "_id", "row", "digest", "kept"]
    rows = [(1, "one two three four five six"), (2, "one two three four five six"), (None, "other"), (3, None)]
    docs = spark.createDataFrame(
        [(i, t, *[n for n in names]) for i, t in rows], ", ".join(["doc_id bigint", "text string", *[f"{n} string" for n in names]])
    )
    got = near_dedup.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == [1, 3, None]


def test_darts_estimate_similarity():
    rng = np.random.default_rng(1)
    off = []
    for n, shared in ((50, 40), (400, 200), (3, 2), (5000, 4500)):
        for _ in range(20):
            pool = rng.integers(0, 2**48, 2 * n - shared, dtype=np.uint64)
            marks = near_dedup.darts(np.concatenate([pool[:n], pool[n - shared :]]), np.array([n, n]))
            assert (marks != 0).all()
            off.append((marks[0] == marks[1]).mean() - shared / (2 * n - shared))
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.06


def test_darts_follow_weights():
    rng = np.random.default_rng(2)
    found = []
    for _ in range(40):
        pool = rng.integers(0, 2**48, 60, dtype=np.uint64)
        a, b = rng.uniform(0, 3, 60), rng.uniform(0, 3, 60)
        marks = near_dedup.darts(np.concatenate([pool, pool]), np.array([60, 60]), np.concatenate([a, b]))
        found.append((marks[0] == marks[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(found)) < 0.03


def test_signature_does_not_depend_on_the_batch():
    texts = ["one two three four five six", None, "", "a b", helpers.LONG, "one two three four five six"]
    elements, n = near_dedup.shingles(pa.array(texts))
    together = near_dedup.darts(elements, n)
    for k, text in enumerate(texts):
        alone, m = near_dedup.shingles(pa.array([text]))
        assert m[0] == n[k] == len(shingle_set(text))
        assert (near_dedup.darts(alone, m)[0] == together[k]).all()
