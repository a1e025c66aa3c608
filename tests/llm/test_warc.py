import collections
import hashlib

import pytest

from gridspark.llm import queries, warc
from gridspark.session import scratch_path

FAKE = warc.record(999, "http://x.example/", b"fake payload", hashlib.sha1(b"fake payload").hexdigest(), None).decode()
BIG = "<p>same</p>" * 200
PAGES = [
    (1, "http://a.example/1", "<p>one</p>"),
    (2, "http://a.example/2", FAKE * 5),
    (3, "http://a.example/3", "WARC/1.1\r\nContent-Length: 7\r\n\r\n" * 60),
    (4, "http://a.example/ with space\r\n", BIG),
    (5, None, BIG),
    (6, "http://a.example/6", BIG),
    (6, "http://a.example/6", BIG),
    (7, "http://a.example/7", None),
    (8, "http://a.example/8", ""),
    (9, "http://a.example/9", "é" * 499 + "x"),
    (10, "http://a.example/10", "é" * 499 + "x"),
    (11, "http://a.example/11", "é" * 500),
    (12, "http://a.example/12", "é" * 500),
    (None, "http://a.example/13", BIG),
    (14, "http://a.example/14", "long " * 4_000),
    (15, "http://a.example/" + "u" * 1_000_000, "<p>one</p>"),
]


def expected(pages):
    largest = {}
    for page_id, _, html in pages:
        raw = (html or "").encode()
        if len(raw) >= 1000 and page_id is not None:
            largest[raw] = max(page_id, largest.get(raw, page_id))
    out = []
    for page_id, _, html in pages:
        raw = (html or "").encode()
        top = largest.get(raw, page_id) if page_id is not None else None
        out.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(),
                    "response" if top == page_id else "revisit", None if top == page_id else top))
    return collections.Counter(out)


@pytest.mark.parametrize("range_bytes, compress", [(60_000, False), (8_000_000, False), (300, True), (8_000_000, True)])
def test_round_trip_rejects_magic_in_payloads(spark, range_bytes, compress):
    pages = spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id bigint, url string, html string, payload string")
    folder = scratch_path(spark, "warc-test")
    warc.write(pages.coalesce(2), folder, compress=compress)
    found = warc.read(spark, folder, range_bytes)
    rows = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert collections.Counter(tuple(r) for r in rows) == expected(PAGES)
    responses = {r.page_id: r for r in found.filter("record_type = 'response'").collect()}
    assert bytes(responses[2].payload) == (FAKE * 5).encode() and bytes(responses[14].payload) == ("long " * 4_000).encode()
    assert responses[15].url == PAGES[-1][1]


def other(lines, block):
    """A record as other programs write it."""
    return "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\ncontent-length: 3\r\nX: y\r\n\r\nabcdef"
OTHERS = [
    other(["WARC/1.0", "WARC-Type: warcinfo", "WARC-Record-ID: <urn:uuid:1>", "Content-Type: application/warc-fields"], b"software: x\r\n"),
    other(["WARC/1.0", "WARC-Type: response", "WARC-Record-ID: <urn:uuid:2>", "Content-Type: application/http; msgtype=response",
           "WARC-Target-URI: http://a.example/", "X-Long: " + "v" * 200_000, "\tfolded"], HTTP),
    other(["WARC/1.1", "warc-type: resource", "WARC-Record-ID: <urn:uuid:3>", "WARC-Payload-Digest: sha256:abcd"], b"WARC/1.0\r\nContent-Length: 1\r\n\r\n"),
    other(["WARC/0.17", "WARC-Type: metadata", "WARC-Payload-Digest: sha1:" + hashlib.sha1(b"m").hexdigest().upper()], b"m"),
    other(["WARC/1.0", "WARC-Type: conversion"], b""),
]


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("range_bytes", [2_000, 1_000_000])
def test_archives_of_others(spark, tmp_path, range_bytes, packed):
    folder = tmp_path / "in"
    folder.mkdir()
    name = "x.warc.gz" if packed else "x.warc"
    (folder / name).write_bytes(b"".join(warc.member(r) if packed else r for r in OTHERS * 2))
    (folder / ("empty" + name[1:])).write_bytes(b"")
    found = warc.read(spark, str(folder), range_bytes, files=warc.manifest(spark, str(folder))).orderBy("offset").collect()
    assert [r["record_type"] for r in found] == ["warcinfo", "response", "resource", "metadata", "conversion"] * 2
    assert [r["record_id"] for r in found][:5] == ["<urn:uuid:1>", "<urn:uuid:2>", "<urn:uuid:3>", None, None]
    assert [bytes(r["payload"]) for r in found][:5] == [b"software: x\r\n", b"abcdef", b"WARC/1.0\r\nContent-Length: 1\r\n\r\n", b"m", b""]
    assert all(r["payload_digest"] == hashlib.sha1(r["payload"]).hexdigest() for r in found)
    assert {r["page_id"] for r in found} == {None}


def test_empty_table(spark):
    folder = scratch_path(spark, "warc-test")
    warc.write(spark.createDataFrame([], "page_id bigint, url string, html string"), folder)
    assert warc.read(spark, folder).count() == 0


def test_damaged_records_are_reported():
    raw = warc.record(1, None, b"abc", hashlib.sha1(b"abc").hexdigest(), None)
    assert warc.parse_header(warc.of_bytes(raw), 0)[0]["warc-type"] == "response"
    assert warc.parse_header(warc.of_bytes(raw[:40]), 0) is None
    assert warc.links(warc.of_bytes(raw + raw), 2 * len(raw)) == [(len(raw), 2 * len(raw)), (0, 2 * len(raw))]
    assert warc.links(warc.of_bytes(warc.member(raw)[:-9]), 50, True) == []
    for spoilt in (raw[:-2], raw[:-5] + b"x" + raw[-4:]):
        with pytest.raises(ValueError):
            for _, fields, block in warc._records(warc.of_bytes(spoilt), 0, len(spoilt), False):
                warc._row(fields, block, True)


def test_query_keeps_its_archives_packed(spark, sf_dir, monkeypatch):
    folders, real = [], queries.scratch_path
    monkeypatch.setattr(queries, "scratch_path", lambda *args: folders.append(real(*args)) or folders[-1])
    payload = queries.op10_warc(spark, sf_dir).filter("record_type = 'response'").agg({"payload_bytes": "sum"}).first()[0]
    assert warc.manifest(spark, folders[0]).agg({"bytes": "sum"}).first()[0] < payload
