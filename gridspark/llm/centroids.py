"""Centroid clustering of integer vectors, filtered by leading rotated coordinates.

Components become integers, ``floor(1024 * x)``, and all decisions are made on
integers. A filter saves most of the distances: the vectors are rotated to the
principal axes of the table and stored with their leading coordinates and the
norm of the rest. For a vector and a centroid,

    |lead - lead'|^2 + (rest - rest')^2  <=  squared distance,

because two parts of given norms are at least the difference of the norms apart.
A centroid whose bound exceeds an exact distance already known cannot be the
nearest; the distances to the others are computed in integers. The bound is
lowered by more than its rounding error, so the filter never decides a tie.

Each round is one pass over the stored table: a task assigns its vectors and
sends one sum per centroid, whatever the sizes of the clusters. The driver holds
the centroids and a matrix of the dimension only.

Defined results:

* vectors without exactly ``dimensions`` components, or with a component that is
  null or not finite, are left out; null arrays and empty tables give no rows;
* repeated rows are vectors of their own; among the first centroids rows of
  equal ids go by their components, and rows without an id come last;
* with fewer vectors than centroids every vector starts one;
* equally near centroids: the smaller number, also for equal centroids;
* a component beyond +-2^27 raises an error, as distances would leave 64 bits;
* other columns are never looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.session import materialise

SCALE = 1024
DIMENSIONS = 64
CENTROIDS = 8
ROUNDS = 10
# Rotated coordinates kept beside each vector.
LEADING = 16
LARGEST = 1 << 27
# Share of the squared norms by which bounds are lowered, far above the rounding
# error of 64-bit floats (about 1e-13).
SLACK = 1e-9

INTEGERS = "vec_id bigint, v array<int>"
STORED = INTEGERS + ", lead array<double>, rest double"
ASSIGNED = "vec_id bigint, cluster int, distance bigint"
OUT = ASSIGNED + ", cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def integers(vectors: DataFrame, id_column: str, vector_column: str, dimensions: int) -> DataFrame:
    """The vectors that count, in integers."""
    vector = F.col(vector_column)
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    usable = F.when(F.size(vector) == dimensions, finite).otherwise(False)

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * SCALE
        far = F.raise_error(F.lit("vector component beyond 2^27"))
        return F.when(F.abs(scaled) > LARGEST, far.cast("int")).otherwise(F.floor(scaled).cast("int"))

    return vectors.filter(usable).select(
        F.col(id_column).cast("bigint").alias("vec_id"), F.transform(vector, whole).alias("v")
    )


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), width)


def _lists(values: np.ndarray) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * np.int32(values.shape[1])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.reshape(-1)))


def _moments(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[pa.RecordBatch]:
    """Number of vectors, their sum and the sum of their outer products."""
    n, total, square = 0, np.zeros(dimensions), np.zeros((dimensions, dimensions))
    for batch in batches:
        block = _matrix(batch.column("v"), dimensions, np.float64)
        n, total, square = n + len(block), total + block.sum(0), square + block.T @ block
    if n:
        flat = np.concatenate([[n], total, square.reshape(-1)])
        yield pa.RecordBatch.from_arrays([_lists(flat.reshape(1, -1))], names=["m"])


@dataclass
class Rotation:
    """Principal axes of the table, widest first."""

    mean: np.ndarray
    axes: np.ndarray
    leading: int

    def apply(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and the norm of the others."""
        turned = (block - self.mean) @ self.axes
        return turned[:, : self.leading], np.sqrt((turned[:, self.leading :] ** 2).sum(1))


def rotation(vectors: DataFrame, dimensions: int, leading: int) -> Rotation:
    """The axes from the covariance of all vectors (eager; one matrix reaches the driver)."""
    moments = (
        vectors.select("v")
        .mapInArrow(partial(_moments, dimensions=dimensions), "m array<double>")
        .select(F.posexplode("m").alias("place", "x"))
        .groupBy("place")
        .agg(F.sum("x").alias("x"))
    )
    flat = np.array([r["x"] for r in sorted(moments.collect(), key=lambda r: r["place"])])
    mean = flat[1 : dimensions + 1] / flat[0]
    spread = flat[dimensions + 1 :].reshape(dimensions, dimensions) / flat[0] - np.outer(mean, mean)
    return Rotation(mean, np.linalg.eigh(spread)[1][:, ::-1].copy(), min(leading, dimensions))


def _rotated(batches: Iterator[pa.RecordBatch], turn: Rotation) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            lead, rest = turn.apply(_matrix(batch.column("v"), len(turn.mean), np.float64))
            names = ["vec_id", "v", "lead", "rest"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), _lists(lead), pa.array(rest)], names=names
            )


@dataclass
class Centroids:
    """Integer centroids with the coordinates that the filter compares."""

    values: list[list[int]]
    turn: Rotation

    def __post_init__(self) -> None:
        self.whole = np.array(self.values, dtype=np.int64)
        self.lead, self.rest = self.turn.apply(self.whole.astype(np.float64))
        self.size = (self.lead**2).sum(1) + self.rest**2

    def nearest(self, block: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each vector and the squared distance, exactly."""
        bound = ((lead[:, None, :] - self.lead) ** 2).sum(2) + (rest[:, None] - self.rest) ** 2
        size = (lead**2).sum(1) + rest**2
        bound -= SLACK * (size[:, None] + self.size) + SLACK
        guess = bound.argmin(1)
        cluster, best = guess.copy(), ((block - self.whole[guess]) ** 2).sum(1)
        for k, centre in enumerate(self.whole):
            survivors = np.flatnonzero((bound[:, k] <= best) & (guess != k))
            distance = ((block[survivors] - centre) ** 2).sum(1)
            known = best[survivors]
            better = (distance < known) | ((distance == known) & (k < cluster[survivors]))
            cluster[survivors[better]], best[survivors[better]] = k, distance[better]
        return cluster, best


def _assignments(batches: Iterator[pa.RecordBatch], centres: Centroids) -> Iterator[tuple]:
    width = len(centres.turn.mean)
    for batch in batches:
        if batch.num_rows:
            block = _matrix(batch.column("v"), width, np.int64)
            lead = _matrix(batch.column("lead"), centres.turn.leading, np.float64)
            rest = batch.column("rest").to_numpy(zero_copy_only=False)
            yield batch, block, *centres.nearest(block, lead, rest)


def _sums(batches: Iterator[pa.RecordBatch], centres: Centroids) -> Iterator[pa.RecordBatch]:
    """Per centroid the number and the sum of a task's vectors."""
    counts = np.zeros(len(centres.whole), dtype=np.int64)
    sums = np.zeros_like(centres.whole)
    for _, block, cluster, _ in _assignments(batches, centres):
        counts += np.bincount(cluster, minlength=len(counts))
        for k in np.unique(cluster):
            sums[k] += block[cluster == k].sum(0)
    met = np.flatnonzero(counts)
    if len(met):
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), _lists(np.column_stack([counts, sums])[met])], names=["cluster", "sums"]
        )


def _assigned(batches: Iterator[pa.RecordBatch], centres: Centroids) -> Iterator[pa.RecordBatch]:
    for batch, _, cluster, distance in _assignments(batches, centres):
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
            names=["vec_id", "cluster", "distance"],
        )


def _moved(stored: DataFrame, centres: Centroids) -> Centroids:
    """Centroids after one round: floors of the exact means, empty ones as they were (eager)."""
    totals = (
        stored.mapInArrow(partial(_sums, centres=centres), "cluster int, sums array<bigint>")
        .select("cluster", F.posexplode("sums").alias("place", "x"))
        .groupBy("cluster", "place")
        .agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    )
    found = {(r["cluster"], r["place"]): int(r["x"]) for r in totals.collect()}
    values = [
        [found[k, place + 1] // found[k, 0] for place in range(len(old))] if (k, 0) in found else old
        for k, old in enumerate(centres.values)
    ]
    return Centroids(values, centres.turn)


def by_digest(seed: str = "3:") -> Callable[[Column], Column]:
    """Order of the first centroids: the SHA-256 digest of ``seed`` and the id."""
    return lambda vec_id: F.sha2(F.concat(F.lit(seed), vec_id.cast("string")), 256)


def cluster(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    leading: int = LEADING,
    start_order: Callable[[Column], Column] = by_digest(),
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    One job a round (eager); only centroids and their sums reach the driver.
    """
    spark = vectors.sparkSession
    whole = materialise(integers(vectors, id_column, vector_column, dimensions), "centroids-integers")
    first = whole.orderBy(start_order(F.col("vec_id")).asc_nulls_last(), "v").limit(centroids).collect()
    if not first:
        return spark.createDataFrame([], OUT)
    turn = rotation(whole, dimensions, leading)
    stored = materialise(whole.mapInArrow(partial(_rotated, turn=turn), STORED), "centroids-rotated")
    centres = Centroids([list(r["v"]) for r in first], turn)
    for _ in range(rounds):
        centres = _moved(stored, centres)
    assigned = materialise(stored.mapInArrow(partial(_assigned, centres=centres), ASSIGNED), "centroids-assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"))
    inertia = {r["cluster"]: int(r["d"]) for r in sums.collect()}
    named = [
        (k, inertia.get(k, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
        for k, v in enumerate(centres.values)
    ]
    # One row per centroid: bounded by the parameter.
    names = spark.createDataFrame(named, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(names), "cluster").select([c.split()[0] for c in OUT.split(", ")])
