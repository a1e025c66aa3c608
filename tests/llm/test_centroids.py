import hashlib
import math
import random

import numpy as np
import pytest

from gridspark.llm import centroids, queries
from tests.llm.helpers import rows

VECTORS = "vec_id bigint, embedding array<float>, cluster string, v string, lead int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "x", "y", 0) for i, v in vectors], VECTORS).repartition(3)


def brute(vectors, dims, k, rounds):
    """The rule on Python integers, one vector at a time."""
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v])
        for i, v in vectors
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]

    def order(row):
        return (row[0] is None, hashlib.sha256(f"3:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])

    centres = [v for _, v in sorted(kept, key=order)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [
            [sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centres)
        ]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = [sum(d for _, n, d in found if n == k) for k in range(len(centres))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, n, d, inertia[n], sum(inertia), names[n]) for i, n, d in found]


def same(got, want):
    key = repr
    assert sorted(rows(got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("leading", [0, 2, 4])
@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed, leading):
    rng = random.Random(seed)
    vectors = [(i, [rng.choice([rng.gauss(0, 1), -0.25, 0.5, 300.0 * seed]) for _ in range(4)]) for i in range(120)]
    got = centroids.cluster(table(spark, vectors), centroids=5, rounds=4, dimensions=4, leading=leading)
    same(got, brute(vectors, 4, 5, 4))


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [-3.5, 0.0]), (2, [1.0, 2.0]), (3, None), (4, []), (5, [1.0]),
        (6, [1.0, None]), (7, [nan, 0.0]), (8, [0.0, -inf]), (9, [1.0, 2.0, 3.0]), (None, [0.5, 0.5]),
        (10, [-0.0001, 0.0]), (11, [100000.0, -100000.0]), (12, [0.75, 1.25]), (13, [0.25, -0.25]),
    ]
    for k in (1, 3, 20):
        got = centroids.cluster(table(spark, vectors), centroids=k, rounds=3, dimensions=2, leading=1)
        same(got, brute(vectors, 2, k, 3))


def test_equal_vectors_and_ties(spark):
    vectors = [(i, [1.0, 1.0]) for i in range(30)] + [(100 + i, [float(i % 3), 1.0]) for i in range(9)]
    got = centroids.cluster(table(spark, vectors), centroids=6, rounds=5, dimensions=2, leading=1)
    same(got, brute(vectors, 2, 6, 5))


def test_nothing_to_cluster(spark):
    assert rows(centroids.cluster(table(spark, [(1, [1.0]), (2, None)]))) == []
    assert centroids.cluster(table(spark, []).limit(0)).columns == [c.split()[0] for c in centroids.OUT.split(", ")]


def test_too_wide_components_are_refused(spark):
    with pytest.raises(Exception, match="beyond 2\\^27"):
        centroids.cluster(table(spark, [(1, [3e38, 0.0])]), dimensions=2)


def test_bounds_never_exceed_distances(spark):
    rng = np.random.default_rng(4)
    axes = np.linalg.qr(rng.normal(size=(6, 6)))[0]
    for scale in (1, 1 << 26):
        block = rng.integers(-scale, scale, size=(200, 6), endpoint=True)
        turn = centroids.Rotation(block.mean(0), axes, 2)
        centres = centroids.Centroids([list(map(int, v)) for v in block[:7]], turn)
        cluster, distance = centres.nearest(block, *turn.apply(block.astype(float)))
        every = ((block[:, None, :] - centres.whole) ** 2).sum(2)
        assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_query_covers_the_table(spark, sf_dir):
    got = queries.QUERIES["op12_centroids"](spark, sf_dir)
    assert got.count() == queries.table(spark, sf_dir, "embeddings").count()
