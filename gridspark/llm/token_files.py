"""Token-id files with shuffled planes.

A data set is a folder of files in ascending document order. A file holds ids in
blocks of a fixed number; each block is transposed into byte planes (or bit
planes), and each plane is compressed by zstandard on its own, so that the
nearly constant high planes shrink to almost nothing. The end of a file carries
a chunk index (place and length of every plane) and the documents' ids and
lengths, so any block can be read alone::

    "PLANES01" | planes of block 0 | planes of block 1 | ... | index | trailer

The index is zstandard-compressed; the trailer is its offset and length and the
kind of plane. ``manifest`` inside the folder lists the committed files.

Defined results: a null text has no ids besides the end id; rows without a
document id come first; repeated ids follow each other, ordered by text; an
empty table gives an empty data set. Texts of any length are taken whole; columns
of any other name are never looked at.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm import shared_files, tokens

MAGIC = b"PLANES01"
TRAILER = struct.Struct("<QQQ8s")
KINDS = ("byte", "bit")
BLOCK_IDS = 1 << 16
LEVEL = 3
BATCH_ROWS = 20_000
MANIFEST = "file string, n_ids bigint, n_docs bigint"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """Planes of one block of 32-bit ids, the lowest first."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [raw[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, k]).tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n_ids: int, kind: str) -> np.ndarray:
    if kind == "byte":
        raw = np.stack([np.frombuffer(p, dtype=np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, dtype=np.uint8), count=n_ids) for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


class PlaneWriter:
    """Writes one file; holds at most one block of ids and the documents' lengths."""

    def __init__(self, stream, kind: str = "byte", block_ids: int = BLOCK_IDS):
        self.stream, self.kind, self.block_ids = stream, kind, block_ids
        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.place = len(MAGIC)
        self.blocks: list[list[int]] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        stream.write(MAGIC)

    def add(self, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.lengths += lengths.tolist()
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= self.block_ids:
            whole = np.concatenate(self.waiting)
            full = len(whole) - len(whole) % self.block_ids
            for at in range(0, full, self.block_ids):
                self._block(whole[at : at + self.block_ids])
            self.waiting, self.n_waiting = [whole[full:]], len(whole) - full

    def _block(self, ids: np.ndarray) -> None:
        packed = [self.compress(p) for p in to_planes(ids, self.kind)]
        self.blocks.append([self.place, len(ids), *map(len, packed)])
        for plane in packed:
            self.stream.write(plane)
            self.place += len(plane)

    def close(self) -> None:
        rest = np.concatenate(self.waiting) if self.waiting else np.empty(0, "<u4")
        if len(rest):
            self._block(rest)
        table = np.array(self.blocks, dtype="<i8").reshape(len(self.blocks), -1)
        known = np.array([d is not None for d in self.doc_ids], dtype=np.uint8)
        named = np.array([d or 0 for d in self.doc_ids], dtype="<i8")
        index = struct.pack("<QQQ", len(self.blocks), table.shape[1] if len(table) else 0, len(named))
        index += table.tobytes() + named.tobytes() + np.array(self.lengths, dtype="<i8").tobytes() + known.tobytes()
        packed = self.compress(index)
        self.stream.write(packed)
        self.stream.write(TRAILER.pack(self.place, len(packed), KINDS.index(self.kind), MAGIC))


class PlaneReader:
    """Reads the index of one file, then its blocks one at a time."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        at, length, kind, magic = TRAILER.unpack(self._range(size - TRAILER.size, TRAILER.size))
        if magic != MAGIC or self._range(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a file of id planes")
        self.kind = KINDS[kind]
        index = zstandard.decompress(self._range(at, length))
        n_blocks, width, n_docs = struct.unpack_from("<QQQ", index)
        at = 24
        self.blocks = np.frombuffer(index, "<i8", n_blocks * width, at).reshape(n_blocks, width) if n_blocks else []
        at += 8 * n_blocks * width
        named = np.frombuffer(index, "<i8", n_docs, at)
        self.lengths = np.frombuffer(index, "<i8", n_docs, at + 8 * n_docs)
        known = np.frombuffer(index, np.uint8, n_docs, at + 16 * n_docs)
        self.doc_ids = [d if k else None for d, k in zip(named.tolist(), known.tolist())]

    def _range(self, at: int, length: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(length)

    def block(self, number: int) -> np.ndarray:
        at, n_ids, *lengths = self.blocks[number].tolist()
        raw, planes = self._range(at, sum(lengths)), []
        for length in lengths:
            planes.append(zstandard.decompress(raw[:length]))
            raw = raw[length:]
        return from_planes(planes, n_ids, self.kind)

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(doc_id, first id in the file, number of ids, CRC-32 of the ids) in file order."""
        held, number, start = b"", 0, 0
        for doc_id, length in zip(self.doc_ids, self.lengths.tolist()):
            crc, missing = 0, 4 * length
            while True:
                crc = zlib.crc32(held[:missing], crc)
                held, missing = held[missing:], missing - len(held[:missing])
                if not missing:
                    break
                held, number = memoryview(self.block(number).tobytes()), number + 1
            yield doc_id, start, length, crc
            start += length


def write(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, kind: str = "byte", block_ids: int = BLOCK_IDS
) -> None:
    """Encode ``docs`` (doc_id, text) into ``folder``; its ``manifest`` appears last."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, number = tokens.encoder(tokenizer), TaskContext.get().partitionId()
        first = next(batches, None)
        if first is None:
            return
        name = f"ids-{number:08d}.planes"
        with shared_files.replaced(f"{folder}/{name}") as stream:
            out = PlaneWriter(stream, kind, block_ids)
            batch = first
            while batch is not None:
                named, texts = batch.column("doc_id"), batch.column("text")
                for a, b in tokens.runs(texts):
                    ids, lengths = tokens.with_end(*coder.encode(texts[a:b]), end_id)
                    out.add(named[a:b].to_pylist(), lengths, ids)
                batch = next(batches, None)
            out.close()
        yield pa.RecordBatch.from_pydict({"file": [name], "n_ids": [out.n_ids], "n_docs": [len(out.lengths)]})

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(part, MANIFEST).write.parquet(f"{folder}/manifest")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per stored document: doc_id, start, n_tokens, ids_crc32 (from the decoded planes)."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch.column("file").to_pylist(), batch.column("ids_before").to_pylist()):
                with shared_files.opened(f"{folder}/{name}") as stream:
                    rows = []
                    for doc_id, start, n_tokens, crc in PlaneReader(stream).documents():
                        rows.append((doc_id, before + start, n_tokens, crc))
                        if len(rows) == BATCH_ROWS:
                            yield _rows(rows)
                            rows = []
                    if rows:
                        yield _rows(rows)

    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # One row per file meets in this window.
    before = F.sum("n_ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    starts = manifest.select("file", F.coalesce(before, F.lit(0)).alias("ids_before"))
    return starts.repartition(max(1, manifest.count())).mapInArrow(part, DOCUMENTS)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ("doc_id", "start", "n_tokens", "ids_crc32")
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
