"""Near-duplicate classes by DartMinHash signatures and banded joining.

A text is a set of shingles of ``WORDS`` lower-case words (a shorter text is one
shingle). Hashed darts are thrown into each element's region of weight and rank,
slab by slab of rising rank; a signature keeps the earliest dart of each
coordinate, and stops at the slab that fills the last one, so the work is a few
hashes per shingle and about K log K darts per text. Elements may have weights:
a dart counts when it falls below the weight.

Texts with one shingle set are one node. Nodes that share a band are candidates;
every candidate link is verified by the exact Jaccard similarity of the sets.
No bucket is expanded into all its pairs:

1. each bucket has a leader, the node with most company over all bands, and every
   other node of it is compared with the leader;
2. nodes that are not linked to their leader are compared with the rest of the
   bucket in tiles of bounded size, until they are linked to it: by signatures first,
   and the sets of those alone that have a like one in a tile go there.

A link left out this way joins two nodes that other links already join, so the
classes (connected components) are those of all candidate links.

Defined results: a null text has no words; texts without words are one class;
rows without an id belong to a class by their text and never name it; repeated
rows fall in one class; an empty table gives an empty result. Texts of any length
are taken whole. Other columns, whatever their names, are never looked at and
``keep_one`` hands them on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm import tokens
from gridspark.session import materialise, small_batches

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 24, 5
COORDINATES = BANDS * ROWS
# Pairs below this share of equal coordinates are not verified: more than five
# standard deviations below SIMILAR. None verifies every candidate.
ESTIMATE = 0.6
FIRST_SLAB, LARGEST_SLAB = 2.0**-6, 64.0
TILE = 256
RUN_BYTES = 2_000_000
NO_ID = -(2**63)
FIRST_FACTOR = np.uint64(0x9E3779B97F4A7C15)
SECOND_FACTOR = np.uint64(0xD6E8FEB86659FD93)
SIGNATURES = "doc_id bigint, digest binary, bands array<bigint>, signature binary"
SETS = "digest binary, elements binary"
LINKS = "a binary, b binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * FIRST_FACTOR
    x ^= x >> np.uint64(29)
    x *= SECOND_FACTOR
    x ^= x >> np.uint64(32)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)) * 2.0**-53


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (48 bits) of all texts, sorted in each, and their number per text."""
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.utf8_split_whitespace(texts)
    words = lists.flatten()
    filled = pc.not_equal(words, "")
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    owner = owner[filled.to_numpy(zero_copy_only=False)]
    words = words.filter(filled).dictionary_encode()
    hashed = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary)
    )
    each = hashed[words.indices.to_numpy(zero_copy_only=False)]
    count = np.bincount(owner, minlength=len(lists)).astype(np.int64)
    end = np.cumsum(count)[owner] if len(owner) else owner
    place = np.arange(len(each))
    total = np.zeros(len(each), np.uint64)
    for k in range(WORDS):
        inside = place + k < end
        total[inside] += _mix(each[place[inside] + k] + _times(k + 1, SECOND_FACTOR))
    starts = np.cumsum(count) - count
    good = place + WORDS <= end
    good[starts[count > 0]] = True
    keys = np.unique(owner[good].astype(np.uint64) << np.uint64(48) | _mix(total[good]) >> np.uint64(16))
    n = np.bincount((keys >> np.uint64(48)).astype(np.int64), minlength=len(lists))
    return keys & np.uint64(2**48 - 1), n.astype(np.int64)


def _times(n: int, factor: np.uint64) -> np.uint64:
    """A product modulo 2^64."""
    return np.uint64(n * int(factor) & 0xFFFFFFFFFFFFFFFF)


def darts(
    elements: np.ndarray, n: np.ndarray, weights: np.ndarray | None = None, k: int = COORDINATES
) -> np.ndarray:
    """Signatures (texts x k) of sets lying one after the other, ``n`` elements each.

    ``weights`` (default 1) are at least 0. A set without weight has the signature 0.
    """
    owner = np.repeat(np.arange(len(n)), n)
    if weights is None:
        limit = np.ones(len(elements))
    else:
        # One region per unit of weight; the last may be lower.
        cells = np.ceil(weights).astype(np.int64)
        cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
        owner, elements, limit = (np.repeat(x, cells) for x in (owner, elements, weights))
        limit = np.minimum(1.0, limit - cell)
        elements = elements + cell.astype(np.uint64) * SECOND_FACTOR
    signature = np.zeros((len(n), k), np.uint64)
    filled = np.zeros((len(n), k), bool)
    open_ = np.bincount(owner, weights=limit, minlength=len(n)) > 0
    low, height, slab = 0.0, FIRST_SLAB, 0
    while open_.any():
        live = open_[owner]
        owner, elements, limit = owner[live], elements[live], limit[live]
        # Poisson many darts in each element's region of this slab, by inversion.
        law = np.cumsum(_poisson(height))
        seed = _mix(elements + _times(slab + 1, FIRST_FACTOR))
        number = np.searchsorted(law, _unit(_mix(seed)), side="right")
        hit = np.flatnonzero(number)
        number = number[hit]
        which = np.repeat(hit, number)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
        dart = _mix(seed[which] ^ _mix((nth + 1).astype(np.uint64)))
        kept = _unit(_mix(dart ^ FIRST_FACTOR)) < limit[which]
        which, dart = which[kept], dart[kept]
        coordinate = (dart % np.uint64(k)).astype(np.int64)
        cell = owner[which] * k + coordinate
        new = ~filled.reshape(-1)[cell]
        cell, dart = cell[new], dart[new]
        rank = _mix(dart ^ SECOND_FACTOR)  # within the slab
        order = np.lexsort((rank, cell))
        cell, dart = cell[order], dart[order]
        first = np.ones(len(cell), bool)
        first[1:] = cell[1:] != cell[:-1]
        signature.reshape(-1)[cell[first]] = dart[first]
        filled.reshape(-1)[cell[first]] = True
        open_ &= ~filled.all(axis=1)
        low, slab = low + height, slab + 1
        height = min(LARGEST_SLAB, low)
    return signature


def _poisson(mean: float) -> np.ndarray:
    """Probabilities of 0, 1, 2, ... up to where they vanish."""
    top = int(mean + 12 * np.sqrt(mean) + 20)
    k = np.arange(1, top)
    return np.exp(np.concatenate([[0.0], np.cumsum(np.log(mean / k))]) - mean)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the shingle set, band keys and one byte per coordinate."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, texts = batch.column("doc_id"), batch.column("text")
            for a, b in tokens.runs(texts, RUN_BYTES):
                elements, n = shingles(texts[a:b])
                marks = darts(elements, n)
                keys = _mix(marks.reshape(len(n), BANDS, ROWS) + np.arange(1, ROWS + 1, dtype=np.uint64) * FIRST_FACTOR)
                keys = _mix(keys.sum(axis=2, dtype=np.uint64)).view(np.int64)
                bytes_ = _mix(marks).astype(np.uint8)
                ends = np.cumsum(n)
                raw = memoryview(elements.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        named[a:b].cast(pa.int64()),
                        pa.array([hashlib.md5(raw[8 * (e - c) : 8 * e]).digest() for e, c in zip(ends.tolist(), n.tolist())], pa.binary()),
                        pa.array([k if c else [] for k, c in zip(keys.tolist(), n.tolist())], pa.list_(pa.int64())),
                        pa.array([s.tobytes() for s in bytes_], pa.binary()),
                    ],
                    names=["doc_id", "digest", "bands", "signature"],
                )

    return docs.select("doc_id", "text").mapInArrow(part, SIGNATURES)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """digest and sorted elements of each text's shingle set."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in tokens.runs(texts, RUN_BYTES):
                elements, n = shingles(texts[a:b])
                ends, raw = np.cumsum(n).tolist(), elements.tobytes()
                sets = [raw[8 * (e - c) : 8 * e] for e, c in zip(ends, n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashlib.md5(s).digest() for s in sets], pa.binary()), pa.array(sets, pa.binary())],
                    names=["digest", "elements"],
                )

    return docs.select("text").mapInArrow(part, SETS)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays of distinct elements."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def _estimated(pairs: DataFrame, nodes: DataFrame, estimate: float | None) -> DataFrame:
    """``pairs`` whose signatures agree often enough to be verified."""
    if estimate is None:
        return pairs

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint8).reshape(-1, COORDINATES)
                for n in ("left", "right")
            )
            good = pa.array((left == right).mean(axis=1) >= estimate)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(good), batch.column("b").filter(good)], names=["a", "b"])

    left = nodes.select(F.col("digest").alias("a"), F.col("signature").alias("left"))
    right = nodes.select(F.col("digest").alias("b"), F.col("signature").alias("right"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right").mapInArrow(part, LINKS)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` whose sets are similar enough."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                similarity(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) >= SIMILAR
                for x, y in zip(batch.column("left"), batch.column("right"))
            ]
            good = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(good), batch.column("b").filter(good)], names=["a", "b"])

    left = sets.select(F.col("digest").alias("a"), F.col("elements").alias("left"))
    right = sets.select(F.col("digest").alias("b"), F.col("elements").alias("right"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right").mapInArrow(part, LINKS).distinct()


def _sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """The shingle sets of the nodes in ``wanted`` (digest), from one text of each."""
    ids = nodes.join(wanted, "digest", "left_semi").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id")).distinct()
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), "text").join(ids, "_id", "left_semi")
    return shingle_sets(texts)


TILE_ORDER = ["band", "key", "row_tile", "column_tile"]
TILE_TYPES = [pa.int32(), *[pa.int64()] * 3, *[pa.binary()] * 2, *[pa.bool_()] * 2, pa.binary()]
TILE_ROWS = (
    "band int, key bigint, row_tile bigint, column_tile bigint, leader binary, digest binary, asks boolean,"
    " linked boolean, signature binary"
)


def _tiles(members: DataFrame) -> DataFrame:
    """Rows of the buckets with unlinked nodes, dealt to tiles.

    ``members``: band, key, leader, digest, linked, and the counts ``asking`` and
    ``size`` of the bucket. A node that asks goes to each tile of a row, every
    node to each tile of a column.
    """
    rows = F.ceil(F.col("asking") / TILE)
    columns = F.ceil(F.col("size") / TILE)
    # An independent hash, so that tiles differ from partitions.
    draw = F.xxhash64("digest", F.lit(1))
    asks = members.filter(~F.col("linked")).select(
        "*", F.pmod(draw, rows).alias("row_tile"), F.explode(F.sequence(F.lit(0).cast("bigint"), columns - 1)).alias("column_tile"), F.lit(True).alias("asks")
    )
    answers = members.select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), rows - 1)).alias("row_tile"), F.pmod(draw, columns).alias("column_tile"), F.lit(False).alias("asks")
    )
    return asks.unionByName(answers).drop("asking", "size")


def _grouped(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """The rows of each tile, from batches in the order of tiles."""
    key, rows = None, []
    for batch in batches:
        keys = zip(*(batch.column(n).to_pylist() for n in TILE_ORDER))
        for now, row in zip(keys, zip(*(batch.column(n).to_pylist() for n in names))):
            if now != key and rows:
                yield key, rows
                rows = []
            key = now
            rows.append(row)
    if rows:
        yield key, rows


def _in_tiles(rows: DataFrame) -> DataFrame:
    return rows.repartition(*TILE_ORDER).sortWithinPartitions(*TILE_ORDER)


def _likely_rows(rows: list[tuple], estimate: float | None) -> list[tuple]:
    """Rows of a tile that the comparison by sets needs: nodes that ask, and what is like one of them.

    ``rows``: (leader, digest, asks, linked, signature).
    """
    answers, asking = [r for r in rows if not r[2]], [r for r in rows if r[2]]
    if estimate is None:
        return rows
    table = np.frombuffer(b"".join(r[4] for r in answers), np.uint8).reshape(-1, COORDINATES)
    wanted, found = np.zeros(len(answers), bool), []
    for r in asking:
        near = (table == np.frombuffer(r[4], np.uint8)).mean(axis=1) >= estimate
        for k in np.flatnonzero(near).tolist():
            # Itself and the leader, which has been compared, are no news.
            near[k] = answers[k][1] not in (r[1], r[0])
        if near.any():
            wanted |= near
            found.append(r)
    return found + [r for r, w in zip(answers, wanted) if w]


def _compare_tile(rows: list[tuple], estimate: float | None = ESTIMATE) -> list[tuple[bytes, bytes]]:
    """Verified links of the asking nodes of one tile: at most one into what is joined already.

    ``rows``: (digest, asks, linked, signature, elements, leader).
    """
    parent: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    answers = [r for r in rows if not r[1]]
    for r in answers:
        if r[2]:
            parent[root(r[0])] = root(r[5])
    table = np.frombuffer(b"".join(r[3] for r in answers), np.uint8).reshape(-1, COORDINATES)
    links = []
    for asking in (r for r in rows if r[1]):
        agreed = (table == np.frombuffer(asking[3], np.uint8)).mean(axis=1)
        near = np.flatnonzero(agreed >= (estimate or 0.0))
        own = np.frombuffer(asking[4], np.uint64)
        for k in near[np.argsort(-agreed[near], kind="stable")].tolist():
            other = answers[k]
            if other[0] == asking[5] or root(other[0]) == root(asking[0]):
                continue  # the leader has been compared; joined nodes need no further link
            if similarity(own, np.frombuffer(other[4], np.uint64)) >= SIMILAR:
                links.append((asking[0], other[0]))
                parent[root(asking[0])] = root(other[0])
    return links


def _rest(
    buckets: DataFrame, links: DataFrame, docs: DataFrame, nodes: DataFrame, estimate: float | None
) -> DataFrame:
    """Links that nodes not linked to their leader have inside their buckets."""
    pairs = links.select(F.col("a").alias("leader"), F.col("b").alias("digest"), F.lit(True).alias("found"))
    # A lone pair of nodes has been compared already.
    marked = (
        buckets.filter("size > 2")
        .join(pairs, ["leader", "digest"], "left")
        .select("band", "key", "size", "leader", "digest", (F.coalesce("found", F.lit(False)) | (F.col("leader") == F.col("digest"))).alias("linked"))
    )
    marked = materialise(marked, "near-marked")
    asking = materialise(
        marked.filter(~F.col("linked")).groupBy("band", "key").agg(F.count(F.lit(1)).alias("asking")), "near-asking"
    )
    members = marked.join(asking, ["band", "key"])
    tiles = _tiles(members.join(nodes.select("digest", "signature"), "digest"))
    columns = [c.split()[0] for c in TILE_ROWS.split(", ")]

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _grouped(batches, columns[len(TILE_ORDER) :]):
            kept = _likely_rows(rows, estimate)
            if kept:
                arrays = [pa.array(c, k) for c, k in zip(zip(*((*key, *r) for r in kept)), TILE_TYPES)]
                yield pa.RecordBatch.from_arrays(arrays, names=columns)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, ["digest", "asks", "linked", "signature", "elements", "leader"]):
            yield _link_batch(_compare_tile(rows, estimate))

    some = materialise(_in_tiles(tiles.select(columns)).mapInArrow(likely, TILE_ROWS), "near-tiles")
    sets = materialise(_sets_of(docs, nodes, some.select("digest").distinct()), "near-sets")
    return _in_tiles(some.join(sets, "digest")).mapInArrow(linked, LINKS)


def _link_batch(links: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"a": pa.array([a for a, _ in links], pa.binary()), "b": pa.array([b for _, b in links], pa.binary())}
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) of the connected components of ``links`` (a, b): the smallest node of each.

    Smallest labels spread along the links and along the labels' own labels, so
    a chain shortens by more than half in a round. Each round is a written table.
    """
    both = materialise(links.union(links.select("b", "a")).distinct(), "component-links")
    labels = materialise(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")), "component-labels"
    )
    while True:
        heard = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("root").alias("heard"))
        )
        nearer = materialise(
            labels.join(heard, labels["node"] == heard["a"]).select(
                "node", F.least("root", "heard").alias("root"), F.col("root").alias("was")
            ),
            "component-labels",
        )
        up = nearer.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = materialise(
            nearer.join(up, "root").select("node", F.least("root", "above").alias("root"), "was"), "component-labels"
        )
        if jumped.filter("root != was").isEmpty():
            return jumped.select("node", "root")
        labels = jumped.select("node", "root")


def classes(docs: DataFrame, estimate: float | None = ESTIMATE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, class_id, class_size, kept.

    Candidates whose signatures agree in less than ``estimate`` are not verified.
    """
    with small_batches(docs.sparkSession):
        return _classes(docs, estimate)


def _classes(docs: DataFrame, estimate: float | None) -> DataFrame:
    marks = materialise(signatures(docs), "near-signatures")
    nodes = materialise(
        marks.groupBy("digest").agg(
            F.min("doc_id").alias("doc_id"),
            F.first("bands").alias("bands"),
            F.first("signature").alias("signature"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "near-nodes",
    )
    cells = nodes.select("digest", F.posexplode("bands").alias("band", "key"))
    sizes = materialise(
        cells.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "near-sizes"
    )
    shared = materialise(cells.join(sizes, ["band", "key"]), "near-shared")
    company = shared.groupBy("digest").agg(F.sum("size").alias("company"))
    leaders = materialise(
        shared.join(materialise(company, "near-company"), "digest")
        .groupBy("band", "key")
        .agg(F.max(F.struct("company", "digest"))["digest"].alias("leader")),
        "near-leaders",
    )
    buckets = materialise(shared.join(leaders, ["band", "key"]), "near-buckets")
    pairs = buckets.filter("leader != digest").select(F.col("leader").alias("a"), F.col("digest").alias("b")).distinct()
    likely = materialise(_estimated(pairs, nodes, estimate), "near-likely")
    wanted = likely.select(F.col("a").alias("digest")).union(likely.select("b")).distinct()
    sets = materialise(_sets_of(docs, nodes, wanted), "near-sets")
    links = materialise(_verified(likely, sets), "near-links")
    more = materialise(_rest(buckets, links, docs, nodes, estimate), "near-links")
    roots = components(links.union(more))
    grouped = nodes.join(roots, nodes["digest"] == roots["node"], "left").select(
        "digest", "doc_id", "copies", F.coalesce("root", "digest").alias("root")
    )
    grouped = materialise(grouped, "near-grouped")
    named = materialise(
        grouped.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size")), "near-classes"
    )
    by_digest = materialise(grouped.join(named, "root").select("digest", "class_id", "class_size"), "near-named")
    return marks.select("doc_id", "digest").join(by_digest, "digest").select(
        "doc_id",
        "class_id",
        "class_size",
        F.coalesce(F.col("doc_id") == F.col("class_id"), F.col("class_id").isNull()).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns.

    Rows without an id stay only in classes without any id; where an id names
    several texts of different classes, its rows stay if one of them does.
    """
    gone = classes(docs).filter("NOT kept").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("gone")).distinct()
    # As one struct the columns of ``docs`` clash with no name used here.
    rows = docs.select(F.struct("*").alias("row"))
    stays = rows.join(gone, F.coalesce(F.col("row")["doc_id"], F.lit(NO_ID)) == F.col("gone"), "left_anti")
    return stays.select("row.*")
