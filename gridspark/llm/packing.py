"""Packing documents into fixed windows by non-negative least squares.

A document of L ids is cut into whole windows and one remainder. Shallow
combinations of lengths that fill a window exactly (one, two or three pieces)
are enumerated; their repeat counts solve a non-negative least-squares problem
against the histogram of piece lengths, are rounded down, and what is left over
is packed greedily, also by the histogram. The planning sees one count per
length, so its cost depends on the window and not on the data; pieces find their
place in the plan by their rank among pieces of equal length.

Defined results: a null or empty text is one piece with the end id; rows without
a document id are packed like others; repeated rows are packed repeatedly; an
empty table gives no pieces. Reruns give the same packing. Texts of any length are
taken whole and cut into pieces; columns of any other name are never looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm import tokens
from gridspark.session import materialise, small_batches

WINDOW = 2048
STEPS = 300
# The least rows of a ranking bucket; buckets of a length of n pieces hold this plus sqrt(n).
BUCKET_ROWS = 200
# Bytes of text that are encoded at once.
RUN_BYTES = 4_000_000
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """Whole windows and the remainder of each of ``docs`` (doc_id, text)."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.encoder(tokenizer)
        for batch in batches:
            named, texts = batch.column("doc_id"), batch.column("text")
            for a, b in tokens.runs(texts, RUN_BYTES):
                ids, lengths = tokens.with_end(*coder.encode(texts[a:b]), end_id)
                cuts = -(-lengths // window)
                doc = np.repeat(np.arange(b - a), cuts)
                start = (np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * window
                length = np.minimum(window, lengths[doc] - start)
                first = (np.cumsum(lengths) - lengths)[doc] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * f : 4 * (f + n)]) for f, n in zip(first.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [named[a:b].cast(pa.int64()).take(pa.array(doc)), *map(pa.array, (start, length, crc, lengths[doc]))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    return docs.select("doc_id", "text").mapInArrow(part, PIECES)


def combinations(window: int, present: np.ndarray) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c >= 0, of present lengths that fill the window exactly."""
    have = np.zeros(window + 1, dtype=bool)
    have[present] = True
    a, b = np.meshgrid(np.arange(window + 1), np.arange(window + 1), indexing="ij")
    c = window - a - b
    good = (a >= b) & (b >= c) & (c >= 0) & have[a] & (have[b] | (b == 0)) & (have[np.maximum(c, 0)] | (c == 0))
    return np.stack([a[good], b[good], c[good]], axis=1)


def repeat_counts(combos: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares: counts whose use of each length comes near the histogram.

    Accelerated projected gradient; lengths are weighted by themselves, since an
    unplaced long piece costs more padding.
    """
    window = len(histogram) - 1
    weight = np.arange(window + 1, dtype=float) / window
    weight[0] = 0.0

    def used(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(combos[:, k], weights=x, minlength=window + 1) for k in range(3))

    def slope(x: np.ndarray) -> np.ndarray:
        off = weight * (used(x) - histogram)
        off[0] = 0.0
        return off[combos[:, 0]] + off[combos[:, 1]] + off[combos[:, 2]]

    # The largest curvature, by a few power steps.
    v = np.ones(len(combos))
    for _ in range(12):
        u = weight * used(v)
        v = u[combos[:, 0]] + u[combos[:, 1]] + u[combos[:, 2]]
        top = np.linalg.norm(v)
        v /= top
    x = np.zeros(len(combos))
    y, t = x, 1.0
    for _ in range(steps):
        following = np.maximum(0.0, y - slope(y) / (1.05 * top))
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = following + (t - 1) / t_next * (following - x)
        x, t = following, t_next
    return x


def rounded(combos: np.ndarray, x: np.ndarray, histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Whole repeat counts that never use more pieces than there are, the largest counts first."""
    left = histogram.copy()
    plan = []
    for repeat in (np.floor(x), np.ceil(x)):
        for k in np.argsort(-repeat * (x > 1e-3), kind="stable"):
            wanted = int(repeat[k])
            if not wanted or x[k] <= 1e-3:
                break
            parts = [p for p in combos[k].tolist() if p]
            room = min(left[p] // parts.count(p) for p in parts)
            count = int(min(wanted, room))
            if count:
                plan.append((tuple(parts), count))
                for p in parts:
                    left[p] -= count
        # What rounding down left is offered again by rounding up.
        x = x - np.floor(x)
    histogram[:] = left
    return plan


def greedy(left: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best fit on the histogram: the longest piece opens a window, the longest that fits goes on."""
    window = len(left) - 1
    plan = []
    while left.any():
        parts: list[int] = []
        room, rest = window, left.copy()
        while True:
            fits = np.flatnonzero(rest[: room + 1])
            if not len(fits):
                break
            parts.append(int(fits[-1]))
            rest[fits[-1]] -= 1
            room -= int(fits[-1])
        need = {p: parts.count(p) for p in parts}
        count = int(min(left[p] // n for p, n in need.items()))
        plan.append((tuple(parts), count))
        for p, n in need.items():
            left[p] -= n * count
    return plan


def plan(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(piece lengths, repeats) of all windows; ``histogram[n]`` pieces have length n."""
    left = histogram.astype(np.int64).copy()
    window = len(left) - 1
    found = []
    combos = combinations(window, np.flatnonzero(left))
    if len(combos):
        found = rounded(combos, repeat_counts(combos, left.astype(float)), left)
    return found + greedy(left)


def slots(found: list[tuple[tuple[int, ...], int]], window: int) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first rank, first sequence and offset of each run of slots, by rank."""
    taken = np.zeros(window + 1, dtype=np.int64)
    runs: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for parts, count in found:
        offset = 0
        for part in parts:
            runs.setdefault(part, []).append((int(taken[part]), sequence, offset))
            taken[part] += count
            offset += part
        sequence += count
    return {part: tuple(np.array(c, dtype=np.int64) for c in zip(*rows)) for part, rows in runs.items()}


def pack(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """``cut`` (from ``pieces``, stored) with sequence_id and offset.

    Only the histogram, at most one row per length, comes to the driver; the plan
    that goes out is bounded by the number of combinations it uses.
    """
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    histogram = np.zeros(window + 1, dtype=np.int64)
    for length, n in counts.items():
        histogram[length] = n
    table = slots(plan(histogram), window)
    buckets = F.lit([1 + int(n // (BUCKET_ROWS + math.isqrt(n))) for n in histogram.tolist()])
    # A hot length is ranked in buckets, after the counts of the buckets before.
    spread = cut.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), buckets[F.col("length").cast("int")])
    )
    sizes = spread.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranked"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        spread.withColumn("rank", F.row_number().over(inside) - 1)
        .join(firsts, ["length", "bucket"])
        .withColumn("rank", (F.col("rank") + F.col("ranked")).cast("bigint"))
        .drop("bucket", "ranked")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for part in np.unique(length):
                rows = np.flatnonzero(length == part)
                first, begins, offsets = table[int(part)]
                run = np.searchsorted(first, rank[rows], side="right") - 1
                sequence[rows] = begins[run] + rank[rows] - first[run]
                offset[rows] = offsets[run]
            kept = [batch.column(n) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, PIECES + ", sequence_id bigint, offset bigint")


def packed(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """All of ``docs`` cut and packed; one row per piece."""
    with small_batches(docs.sparkSession):
        cut = materialise(pieces(docs, tokenizer, end_id, window), "pack-pieces")
    return pack(cut, window)
