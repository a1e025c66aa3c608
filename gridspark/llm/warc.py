"""WARC archives: writing with revisit records, and reading with boundary-chain verification.

Writing: each task writes one archive, plain or with each record a gzip member.
Of records with equal payloads (SHA-1 digest and length) of at least ``least``
bytes, the one with the largest id is a ``response``; the others are ``revisit``
records that name it and carry no payload.

Reading: an archive is cut into byte ranges. A task looks for the magic in its
range (of a record, or of a gzip member) and emits, for each candidate that parses
as a record header, the offset of its successor. Payloads may hold the magic, even
whole records, so a candidate only counts when a chain of successors leads to it
from the start of the file: chains are contracted inside each range, then pointer
jumping over the ranges marks the one true entry of each, and the records are
read from there. Headers may have any length; a task reads on until one ends.

Archives of others are read as well: any WARC version, record types other than
``response`` and ``revisit`` (the block is their payload), records without a
digest (it is computed) or with one of another kind. A SHA-1 digest that differs
from its payload, or a record cut short, raises an error.

Defined results: a null payload is empty; null URLs are left out of the header;
rows without a page id are written as responses without a record name and read
back with a null id; repeated rows are written repeatedly, with the same type;
URLs and payloads of any length are kept whole; other columns of ``pages`` are
never looked at; an empty table gives no archives and no records.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm import shared_files
from gridspark.session import materialise

LEAST_REVISIT = 1000
RANGE_BYTES = 8_000_000
# Bytes read at once beyond what is held.
STEP_BYTES = 65_536
DATE = "2024-01-01T00:00:00Z"
MAGIC = b"WARC/1.1\r\n"
ANY_MAGIC = re.compile(rb"WARC/[0-9]+\.[0-9]+\r\n")
GZIP_MAGIC = b"\x1f\x8b\x08"
LONGEST_MAGIC = 32
BLANK = b"\r\n\r\n"
NAME = "<urn:page:{}>"
BATCH_ROWS = 5_000

MANIFEST = "file string, bytes bigint, records bigint"
LINKS = "file string, part bigint, first bigint, last bigint"
RECORDS = (
    "file string, offset bigint, record_id string, page_id bigint, record_type string, refers_to bigint,"
    " payload_bytes bigint, payload_digest string, url string, payload binary"
)


def with_types(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``pages`` (page_id, url, html) as payload rows with their digest and, for revisits, refers_to."""
    rows = pages.select(
        "page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    keyed = materialise(
        rows.filter(F.octet_length("payload") >= least).select("page_id", "digest"), "warc-keys"
    )
    groups = materialise(
        keyed.groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n"),
        "warc-groups",
    )
    revisits = (
        keyed.join(groups, "digest").filter("page_id < refers_to").distinct()
    )
    return rows.join(revisits, ["page_id", "digest"], "left")


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record; a revisit keeps the HTTP header, with the payload's length, and drops the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = ["WARC-Type: " + ("response" if refers_to is None else "revisit")]
    if page_id is not None:
        lines.append("WARC-Record-ID: " + NAME.format(page_id))
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append("WARC-Date: " + DATE)
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        lines.append("WARC-Refers-To: " + NAME.format(refers_to))
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines.append("Content-Type: application/http;msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return MAGIC + "\r\n".join(lines).encode() + BLANK + block + BLANK


def write(pages: DataFrame, folder: str, least: int = LEAST_REVISIT, compress: bool = False) -> None:
    """Archives of ``pages`` in ``folder``; the ``manifest`` of committed files appears last."""
    ending = ".warc.gz" if compress else ".warc"

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, place, records = f"pages-{TaskContext.get().partitionId():08d}{ending}", 0, 0
        first = next(batches, None)
        if first is None:
            return
        with shared_files.replaced(f"{folder}/{name}") as stream:
            batch = first
            while batch is not None:
                names = ("page_id", "url", "payload", "digest", "refers_to")
                for row in zip(*(batch.column(n).to_pylist() for n in names)):
                    raw = member(record(*row)) if compress else record(*row)
                    stream.write(raw)
                    place, records = place + len(raw), records + 1
                batch = next(batches, None)
        yield pa.RecordBatch.from_pydict({"file": [name], "bytes": [place], "records": [records]})

    with_types(pages, least).mapInArrow(part, MANIFEST).write.parquet(f"{folder}/manifest")


def member(raw: bytes) -> bytes:
    """A record as a gzip member of its own."""
    packer = zlib.compressobj(wbits=31)
    return packer.compress(raw) + packer.flush()


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The archives of a folder that has no manifest, by name and size."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder)
    return files.select(name.alias("file"), F.col("length").alias("bytes"), F.lit(None).cast("bigint").alias("records"))


class Ahead:
    """A stretch of a stream that is read as far as it is asked for."""

    def __init__(self, read: Callable[[int, int], bytes], first: int):
        self.read, self.first, self.held = read, first, b""

    def upto(self, end: int) -> bytes:
        """What is held, from ``first`` on, reaching to ``end`` or the end of the stream."""
        missing = end - self.first - len(self.held)
        if missing > 0:
            self.held += self.read(self.first + len(self.held), max(missing, STEP_BYTES, len(self.held)))
        return self.held

    def drop(self, before: int) -> None:
        """Forget what lies before an offset."""
        self.held, self.first = self.held[before - self.first :], before


def of_stream(stream, first: int) -> Ahead:
    def read(at: int, size: int) -> bytes:
        stream.seek(at)
        return stream.read(size)

    return Ahead(read, first)


def of_bytes(raw: bytes, first: int = 0) -> Ahead:
    return Ahead(lambda at, size: raw[at - first : at - first + size], first)


def parse_header(ahead: Ahead, at: int) -> tuple[dict[str, str], int] | None:
    """Fields of the header at ``at`` and the offset of its block; None if it is no header."""
    held = ahead.upto(at + LONGEST_MAGIC)
    begin = ANY_MAGIC.match(held, at - ahead.first)
    if not begin:
        return None
    fields, place, last, look = {}, begin.end(), None, begin.end()
    while True:
        end = held.find(b"\r\n", look)
        if end < 0:
            size = len(held)
            held = ahead.upto(ahead.first + size + 1)
            if len(held) == size:
                return None
            look = max(place, size - 1)
            continue
        line = held[place:end]
        place = look = end + 2
        if not line:
            break
        if line[:1] in (b" ", b"\t") and last:  # a folded line of an old archive
            fields[last] += " " + line.decode("utf-8", "replace").strip()
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        last = name.decode("latin-1").strip().lower()
        fields[last] = value.decode("utf-8", "replace").strip()
    return (fields, ahead.first + place) if re.fullmatch("[0-9]+", fields.get("content-length", "")) else None


def unpacked(ahead: Ahead, at: int) -> Iterator[tuple[bytes, int]]:
    """The gzip member at ``at`` piece by piece, each with the offset behind what it took; the last is empty."""
    unpacker, place = zlib.decompressobj(31), at
    while not unpacker.eof:
        held = ahead.upto(place + 1)
        piece = held[place - ahead.first : place - ahead.first + STEP_BYTES]
        if not piece:
            raise zlib.error("cut short")
        out = unpacker.decompress(piece)
        place += len(piece) - len(unpacker.unused_data)
        yield out, place
    yield b"", place


def successor(ahead: Ahead, at: int, packed: bool) -> int | None:
    """Where the record at ``at`` ends; None if there is none."""
    if not packed:
        found = parse_header(ahead, at)
        return found and found[1] + int(found[0]["content-length"]) + len(BLANK)
    start = b""
    try:
        for out, place in unpacked(ahead, at):
            if len(start) < LONGEST_MAGIC:
                start += out[:LONGEST_MAGIC]
                if len(start) >= LONGEST_MAGIC and not ANY_MAGIC.match(start):
                    return None
    except zlib.error:
        return None
    return place if ANY_MAGIC.match(start) else None


def links(ahead: Ahead, length: int, packed: bool = False) -> list[tuple[int, int]]:
    """Candidates in the ``length`` bytes from ``ahead.first`` on: (offset, first successor beyond them)."""
    first, magic = ahead.first, GZIP_MAGIC if packed else b"WARC/"
    following: dict[int, int] = {}
    at = ahead.upto(first + length + LONGEST_MAGIC).find(magic)
    while 0 <= at < length:
        to = successor(ahead, first + at, packed)
        if to is not None:
            following[at] = to - first
        at = ahead.held.find(magic, at + 1)
    exits: dict[int, int] = {}
    for at in sorted(following, reverse=True):
        to = following[at]
        if to >= length:
            exits[at] = to
        elif to in exits:
            exits[at] = exits[to]
    return [(first + a, first + b) for a, b in exits.items()]


def read(
    spark: SparkSession,
    folder: str,
    range_bytes: int = RANGE_BYTES,
    payloads: bool = True,
    files: DataFrame | None = None,
) -> DataFrame:
    """The records of the archives in ``folder``; without ``payloads`` that column is null.

    ``files`` (file, bytes) names the archives where no manifest does, see ``manifest``.
    """
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest") if files is None else files.filter("bytes > 0")
    last = F.floor((F.col("bytes") - 1) / range_bytes)
    ranges = files.select("file", "bytes", F.explode(F.sequence(F.lit(0), last)).alias("part"))
    n_ranges, most = ranges.agg(F.count(F.lit(1)), F.max("part")).first()
    n_ranges, rounds = max(1, n_ranges), math.ceil(math.log2((most or 0) + 1)) if most else 0

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, size, part in zip(*(batch.column(n).to_pylist() for n in ("file", "bytes", "part"))):
                begin = part * range_bytes
                length = min(range_bytes, size - begin)
                with shared_files.opened(f"{folder}/{name}") as stream:
                    found = links(of_stream(stream, begin), length, name.endswith(".gz"))
                yield pa.RecordBatch.from_pydict(
                    {
                        "file": pa.array([name] * len(found), pa.string()),
                        "part": pa.array([part] * len(found), pa.int64()),
                        "first": pa.array([a for a, _ in found], pa.int64()),
                        "last": pa.array([b for _, b in found], pa.int64()),
                    }
                )

    jumps = materialise(ranges.repartition(n_ranges).mapInArrow(scan, LINKS), "warc-links")
    entries = _reachable(spark, files, jumps, rounds, range_bytes)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, size, entry, part in zip(
                *(batch.column(n).to_pylist() for n in ("file", "bytes", "entry", "part"))
            ):
                rows = []
                with shared_files.opened(f"{folder}/{name}") as stream:
                    end = min(size, (part + 1) * range_bytes)
                    for offset, fields, block in _records(of_stream(stream, entry), entry, end, name.endswith(".gz")):
                        rows.append((name, offset, *_row(fields, block, payloads)))
                        if len(rows) == BATCH_ROWS or (payloads and sum(len(r[-1]) for r in rows) > 8 << 20):
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    return entries.repartition(n_ranges).mapInArrow(fetch, RECORDS)


def _reachable(spark, manifest: DataFrame, jumps: DataFrame, rounds: int, range_bytes: int) -> DataFrame:
    """The true entry of each range: file, bytes, part, entry. Doubles the reach in each round."""
    reach = manifest.select("file", F.lit(0).cast("bigint").alias("at"))
    # Only offsets at which some chain leaves a range can be entries of later ones.
    targets = reach.union(jumps.select("file", F.col("last").alias("at"))).distinct()
    steps = jumps.join(targets, (jumps["file"] == targets["file"]) & (jumps["first"] == targets["at"]), "left_semi")
    steps = steps.select("file", "first", "last")
    for _ in range(rounds):
        steps = materialise(steps, "warc-steps")
        beyond = steps.select("file", F.col("first").alias("at"), F.col("last").alias("beyond"))
        reach = materialise(
            reach.union(reach.join(beyond, ["file", "at"]).select("file", F.col("beyond").alias("at"))).distinct(),
            "warc-reach",
        )
        ahead = beyond.select("file", F.col("at").alias("last"), "beyond")
        steps = steps.join(ahead, ["file", "last"]).select("file", "first", F.col("beyond").alias("last"))
    return (
        reach.join(manifest, "file")
        .filter(F.col("at") < F.col("bytes"))
        .select("file", "bytes", F.floor(F.col("at") / range_bytes).alias("part"), F.col("at").alias("entry"))
    )


def _records(ahead: Ahead, at: int, end: int, packed: bool) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Records from offset ``at`` on that start before ``end``, reading each once."""
    while at < end:
        ahead.drop(at)
        if packed:
            pieces = list(unpacked(ahead, at))
            inner, after = of_bytes(b"".join(out for out, _ in pieces)), pieces[-1][1]
            fields, block, following = _one(inner, 0, at)
        else:
            fields, block, after = _one(ahead, at, at)
        yield at, fields, block
        at = after


def _one(ahead: Ahead, at: int, offset: int) -> tuple[dict[str, str], bytes, int]:
    """Fields and block of the record at ``at``, and where it ends."""
    found = parse_header(ahead, at)
    if not found:
        raise ValueError(f"no record at offset {offset}")
    fields, block = found
    behind = block + int(fields["content-length"])
    held = ahead.upto(behind + len(BLANK))
    if held[behind - ahead.first : behind - ahead.first + len(BLANK)] != BLANK:
        raise ValueError(f"the record at offset {offset} is cut short")
    return fields, held[block - ahead.first : behind - ahead.first], behind + len(BLANK)


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def _sha1(named: str) -> str | None:
    """A ``sha1:`` digest in hexadecimal; None for other kinds."""
    kind, _, value = named.partition(":")
    if kind.lower() != "sha1":
        return None
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def _row(fields: dict[str, str], block: bytes, payloads: bool) -> tuple:
    kind, payload, length = fields.get("warc-type", ""), block, len(block)
    if fields.get("content-type", "").lower().startswith("application/http"):
        head, _, payload = block.partition(BLANK)
        told = re.search(rb"(?im)^Content-Length:[ \t]*(\d+)", head)
        # A revisit tells the length of the payload that it leaves out.
        length = int(told[1]) if kind == "revisit" and told else len(payload)
    digest = _sha1(fields.get("warc-payload-digest", ""))
    if kind != "revisit":
        actual = hashlib.sha1(payload).hexdigest()
        if digest not in (None, actual):
            raise ValueError("a payload differs from its digest")
        digest = actual
    name = fields.get("warc-record-id")
    return (
        name,
        _page(name),
        kind,
        _page(fields.get("warc-refers-to")),
        length,
        digest,
        fields.get("warc-target-uri"),
        payload if payloads else None,
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    text, number = pa.string(), pa.int64()
    kinds = (text, number, text, number, text, number, number, text, text, pa.binary())
    names = [c.split()[0] for c in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
