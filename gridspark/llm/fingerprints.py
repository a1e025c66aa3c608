"""Document fingerprints by locally consistent parsing.

A text is parsed bottom-up into phrases. On each level runs of one symbol are
first joined; deterministic coin tossing then reduces the symbols to a few
labels, in which neighbours still differ, so a local maximum of the labels comes
every few symbols. Maxima start phrases, and a phrase's name is a hash of its
symbols, which are the symbols of the next level. Whether a position starts a
phrase depends on a few symbols around it only: equal substrings get equal
phrases inside, wherever they stand.

A fingerprint keeps, for each of ``LEVELS`` levels, the number of distinct
phrase names and the ``KEPT`` smallest of them (six hexadecimal digits each). The
likeness of two fingerprints estimates the Jaccard similarity of their phrase
sets on the highest level on which both have ``ENOUGH`` phrases, the first level
otherwise; it is exact where both sets are kept whole.

Defined results: a null text is empty; empty texts have equal fingerprints and
likeness 1, and an empty one is unlike any other (0). In ``with_next`` rows
without an id come first, rows with equal ids follow by text, a single row is its
own successor, and an empty table gives an empty result. Texts of any length are taken
whole; columns of any other name are never looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = 3
KEPT = 32
ENOUGH = 8
TOSSES = 3
# Texts are parsed together in runs of about so many characters.
RUN_CHARS = 1_000_000
# Odd multipliers of the mixing function.
FIRST_FACTOR = np.uint64(0x9E3779B97F4A7C15)
SECOND_FACTOR = np.uint64(0xD6E8FEB86659FD93)
RANGES_PER_PARTITION = 4
NO_ID = -(2**63)
OUT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)

Sketch = list[tuple[int, np.ndarray]]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * FIRST_FACTOR
    x ^= x >> np.uint64(29)
    x *= SECOND_FACTOR
    x ^= x >> np.uint64(32)
    return x


def _toss(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One coin toss: the lowest bit in which a symbol differs from its predecessor, and that bit."""
    before = np.empty_like(symbols)
    before[0] = 0
    before[1:] = symbols[:-1]
    differing = symbols ^ before
    lowest = np.bitwise_count((differing & -differing) - differing.dtype.type(1)).astype(symbols.dtype)
    lowest[first] = 0
    bit = (symbols >> np.minimum(lowest, symbols.dtype.type(8 * symbols.itemsize - 1))) & symbols.dtype.type(1)
    return (lowest * symbols.dtype.type(2) + bit).astype(np.uint8)


def next_level(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of texts lying one after the other; ``first`` marks where a text begins."""
    if not len(symbols):
        return symbols, first
    change = first.copy()
    change[1:] |= symbols[1:] != symbols[:-1]
    starts = np.flatnonzero(change)
    run = np.diff(starts, append=len(symbols)).astype(np.uint64)
    symbols, first = symbols[starts], first[starts]
    long = np.flatnonzero(run > 1)
    symbols[long] = _mix(symbols[long] + run[long] * SECOND_FACTOR)
    labels = symbols
    for _ in range(TOSSES):
        labels = _toss(labels, first)
    peak = first.copy()
    rises = labels[1:] > labels[:-1]
    inner = rises[:-1] & ~rises[1:] & (labels[1:-1] > labels[2:]) & ~first[2:]
    peak[1:-1] |= inner
    starts = np.flatnonzero(peak)
    length = np.diff(starts, append=len(symbols))
    place = (np.arange(len(symbols)) - np.repeat(starts, length) + 1).astype(np.uint64)
    names = _mix(np.add.reduceat(_mix(symbols + place * FIRST_FACTOR), starts))
    return names, first[starts]


def sketches(texts: list[str]) -> list[Sketch]:
    """For each text and level: the number of distinct phrases and the smallest names."""
    length = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    symbols = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    first = np.zeros(len(symbols), dtype=bool)
    filled = np.flatnonzero(length)
    first[(np.cumsum(length) - length)[filled]] = True
    found: list[Sketch] = [[] for _ in texts]
    nothing = np.empty(0, dtype=np.uint64)
    for _ in range(LEVELS):
        symbols, first = next_level(symbols, first)
        owner = (np.cumsum(first) - 1).astype(np.uint64)
        keys = np.unique(owner << np.uint64(24) | symbols >> np.uint64(40))
        owner = (keys >> np.uint64(24)).astype(np.int64)
        bounds = np.searchsorted(owner, np.arange(len(filled) + 1))
        names = keys & np.uint64(0xFFFFFF)
        for k, text in enumerate(filled.tolist()):
            a, b = int(bounds[k]), int(bounds[k + 1])
            found[text].append((b - a, names[a : min(b, a + KEPT)]))
    return [s or [(0, nothing)] * LEVELS for s in found]


def as_string(sketch: Sketch) -> str:
    return "|".join(f"{n}:" + "".join(f"{v:06x}" for v in names.tolist()) for n, names in sketch)


def from_string(fingerprint: str) -> Sketch:
    levels = []
    for part in fingerprint.split("|"):
        n, _, digits = part.partition(":")
        names = [int(digits[i : i + 6], 16) for i in range(0, len(digits), 6)]
        levels.append((int(n), np.array(names, dtype=np.uint64)))
    return levels


def likeness(a: Sketch, b: Sketch) -> float:
    """Estimated Jaccard similarity of the phrases of two texts, 0 to 1."""
    level = max((k for k in range(LEVELS) if min(a[k][0], b[k][0]) >= ENOUGH), default=0)
    (n, left), (m, right) = a[level], b[level]
    if not n or not m:
        return float(n == m)
    both = set(left.tolist()) & set(right.tolist())
    either = sorted(set(left.tolist()) | set(right.tolist()))
    if n > KEPT or m > KEPT:
        either = either[:KEPT]
    return sum(v in both for v in either) / len(either)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``following``."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of ``docs`` (doc_id, text) and of its edited text.

    Texts are dealt once, by ranges of ids. The first document of each range goes
    to the range before as well, so that every document meets its successor in
    its own task.
    """
    key = F.coalesce("doc_id", F.lit(NO_ID))
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = RANGES_PER_PARTITION * partitions
    cuts = docs.select(key.alias("key")).agg(
        F.min("key").alias("first"),
        F.percentile_approx("key", [k / ranges for k in range(1, ranges)], 20 * ranges).alias("cuts"),
    ).first()
    if cuts["first"] is None:
        return spark.createDataFrame([], OUT)
    # The first id of each range, every one an id of the table.
    firsts = np.array(sorted({cuts["first"], *cuts["cuts"]}), dtype=np.int64)

    @F.pandas_udf("array<int>")
    def belongs(keys: pd.Series) -> pd.Series:
        keys = keys.to_numpy(dtype=np.int64)
        own = np.searchsorted(firsts, keys, side="right") - 1
        begins = firsts[own] == keys
        return pd.Series([[k, (k - 1) % len(firsts)] if b else [k] for k, b in zip(own.tolist(), begins.tolist())])

    dealt = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("key"))
        .withColumn("ranges", belongs("key"))
        .select("doc_id", "text", "key", F.posexplode("ranges").alias("ahead", "range"))
        .repartition(partitions, "range")
        .sortWithinPartitions("range", "ahead", "key", "text")
    )
    return dealt.select("doc_id", "text", "range", "ahead").mapInArrow(_pairs, OUT)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    chars = 0
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in ("range", "ahead", "doc_id", "text"))):
            held.append(row)
            chars += len(row[3])
            if chars >= RUN_CHARS:
                yield _compared(held)
                held, chars = held[-1:], 0
    if held:
        yield _compared(held)


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    """A result row for each own document whose successor is the next row."""
    own = [k for k in range(len(rows) - 1) if not rows[k][1] and rows[k + 1][0] == rows[k][0]]
    texts = [r[3] for r in rows]
    changed = [edited(texts[k], texts[k + 1]) for k in own]
    marks = sketches(texts)
    new = sketches(changed)
    columns = [
        pa.array([rows[k][2] for k in own], pa.int64()),
        pa.array([len(texts[k]) for k in own], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array([as_string(marks[k]) for k in own], pa.string()),
        pa.array([as_string(s) for s in new], pa.string()),
        pa.array([likeness(marks[k], s) for k, s in zip(own, new)], pa.float64()),
        pa.array([likeness(marks[k], marks[k + 1]) for k in own], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in OUT.split(", ")])
