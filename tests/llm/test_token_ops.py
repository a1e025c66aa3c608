import collections
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridspark import session
from gridspark.llm import packing, queries, token_files, tokens
from gridspark.session import scratch_path
from tests.llm import helpers


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text("aB '.s\x1c\x85 \t́<|endoftx>", max_size=40), max_size=6))
def test_word_encoder_equals_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, lengths = tokens.encoder(helpers.tokenizer()).encode(pa.array(texts, pa.string()))
    want = [e[:-1] for e in helpers.encode(texts, 0)]
    assert lengths.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_forgetting_words_changes_nothing():
    coder = tokens.WordEncoder(helpers.tokenizer(), remembered=5)
    for text in ("one two three four", "five six seven one", "one two three four"):
        ids, _ = coder.encode(pa.array([text]))
        assert ids.tolist() == helpers.encode([text], 0)[0][:-1]


@pytest.mark.parametrize("kind", token_files.KINDS)
def test_planes_round_trip(kind):
    for n in (0, 1, 7, 1000):
        ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
        if n:
            assert (token_files.from_planes(token_files.to_planes(ids, kind), n, kind) == ids).all()


def expected_files(rows, end_id=2):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, out = 0, []
    for row, ids in zip(ordered, helpers.encode([r[1] for r in ordered], end_id)):
        out.append((row[0], start, len(ids), crc(ids)))
        start += len(ids)
    return sorted(out, key=str)


@pytest.mark.parametrize("kind,block", [("byte", 1000), ("bit", 333), ("byte", 1 << 16)])
def test_token_files_round_trip(spark, kind, block):
    folder = scratch_path(spark, "token-test")
    docs = helpers.documents(spark)
    token_files.write(docs, folder, helpers.tokenizer(), 2, kind, block)
    got = helpers.rows(token_files.read_documents(spark, folder))
    assert sorted(got, key=str) == expected_files(helpers.ROWS)


def test_empty_token_files(spark):
    folder = scratch_path(spark, "token-test")
    token_files.write(helpers.documents(spark).limit(0), folder, helpers.tokenizer(), 2)
    assert token_files.read_documents(spark, folder).count() == 0


def test_op7_matches_brute_force(spark, sf_dir):
    got = helpers.rows(queries.op7_token_planes(spark, sf_dir))
    docs = helpers.rows(queries.table(spark, sf_dir, "documents").select("doc_id", "text"))
    assert sorted(got, key=str) == expected_files(docs)


def check_packing(got, rows, end_id=1, window=2048):
    """Every id of every document in exactly one piece; sequences gapless and within the window."""
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset in got:
        pieces[doc_id].append((start, length, ids_crc32, doc_tokens))
        sequences[sequence_id].append((offset, length))
    want = collections.defaultdict(list)
    for row, ids in zip(rows, helpers.encode([r[1] for r in rows], end_id)):
        for at in range(0, len(ids), window):
            part = ids[at : at + window]
            want[row[0]].append((at, len(part), crc(part), len(ids)))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    total = padded = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        total += at
        padded += at if at & (at - 1) == 0 else window
    return padded / max(1, total)


def test_packing_of_awkward_rows(spark):
    got = helpers.rows(packing.packed(helpers.documents(spark), helpers.tokenizer(), 1))
    check_packing(got, helpers.ROWS)
    assert packing.packed(helpers.documents(spark).limit(0), helpers.tokenizer(), 1).count() == 0


def test_op5_matches_brute_force(spark, sf_dir):
    got = helpers.rows(queries.op5_packing(spark, sf_dir))
    docs = helpers.rows(queries.table(spark, sf_dir, "documents").select("doc_id", "text"))
    assert check_packing(got, docs) < 1.05


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_plan_uses_every_piece_once(lengths):
    histogram = np.bincount(lengths, minlength=65) if lengths else np.zeros(65, int)
    used = collections.Counter()
    for parts, count in packing.plan(histogram):
        assert count > 0 and sum(parts) <= 64
        for part in parts:
            used[part] += count
    assert used == collections.Counter(lengths)


def test_least_squares_fills_exactly():
    histogram = np.zeros(2049, int)
    histogram[[700, 1348, 1000, 1048, 2048]] = [900, 900, 500, 500, 40]
    plan = packing.plan(histogram)
    assert sum(c for _, c in plan) == 900 + 500 + 40


def test_packing_hands_texts_over_in_small_batches(spark, monkeypatch):
    seen, real, before = [], packing.materialise, spark.conf.get(session.BATCH_SETTING)
    monkeypatch.setattr(
        packing, "materialise", lambda *args: seen.append(spark.conf.get(session.BATCH_SETTING)) or real(*args)
    )
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    assert packing.packed(docs, helpers.tokenizer(), 1).count() == 2
    assert seen == [session.BATCH_BYTES] and spark.conf.get(session.BATCH_SETTING) == before
