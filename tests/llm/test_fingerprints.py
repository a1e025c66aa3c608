import collections
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridspark.llm import fingerprints, queries
from tests.llm import helpers


def phrases(text, level=1):
    symbols = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    first = np.zeros(len(symbols), dtype=bool)
    first[:1] = True
    for _ in range(level):
        symbols, first = fingerprints.next_level(symbols, first)
    return symbols.tolist()


def exact(a, b):
    """Jaccard similarity of the phrase sets (24-bit names) on the level the fingerprints use."""
    sets = [[{p >> 40 for p in phrases(t, k)} for k in (1, 2, 3)] for t in (a, b)]
    level = max((k for k in range(3) if min(len(sets[0][k]), len(sets[1][k])) >= 8), default=0)
    a, b = sets[0][level], sets[1][level]
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, row in enumerate(ordered):
        text, following = row[1] or "", ordered[(k + 1) % len(ordered)][1] or ""
        n = len(text) // 4
        out.append((row[0], text, text[: len(text) - n] + following[:n], following))
    return out


def check(got, rows):
    want = expected(rows)
    assert collections.Counter((g[0], g[1], g[2]) for g in got) == collections.Counter(
        (i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in want
    )
    by = {(g[0], g[2]): g for g in got}
    off = []
    for doc_id, text, changed, following in want:
        g = by[doc_id, hashlib.sha256(changed.encode()).hexdigest()]
        plain = [fingerprints.as_string(s) for s in fingerprints.sketches([text, changed])]
        assert [g[3], g[4]] == plain
        off += [g[5] - exact(text, changed), g[6] - exact(text, following)]
    assert np.abs(off).max() < 0.45 and np.sqrt(np.mean(np.square(off))) < 0.1


def test_awkward_rows(spark):
    check(helpers.rows(fingerprints.with_next(helpers.documents(spark))), helpers.ROWS)
    assert fingerprints.with_next(helpers.documents(spark).limit(0)).count() == 0
    one = helpers.rows(fingerprints.with_next(helpers.documents(spark, helpers.ROWS[:1])))
    check(one, helpers.ROWS[:1])


def test_op6_matches_brute_force(spark, sf_dir):
    docs = helpers.rows(queries.table(spark, sf_dir, "documents").select("doc_id", "text"))
    got = helpers.rows(queries.op6_fingerprints(spark, sf_dir))
    check(got, docs)
    near = np.array([(g[5], g[6]) for g in got if g[1] >= 200])
    assert near[:, 0].mean() > 0.5 and near[:, 1].mean() < 0.1


@settings(max_examples=60, deadline=None)
@given(st.text("abcdef ", min_size=150, max_size=300), st.text(max_size=40), st.text(max_size=40))
def test_equal_substrings_share_inner_phrases(middle, before, after):
    plain, moved = phrases(middle), phrases(before + middle + after)
    inner = plain[8:-8]
    assert any(moved[k : k + len(inner)] == inner for k in range(len(moved)))


@pytest.mark.parametrize("text", ["", "a", "aaaa", "abab" * 50, "a" * 10_000, "\U0001f600é"])
def test_any_text_has_a_fingerprint(text):
    alone = fingerprints.sketches([text])[0]
    among = fingerprints.sketches(["xyz", text, "", "more text"])[1]
    assert fingerprints.as_string(alone) == fingerprints.as_string(among)
    again = fingerprints.from_string(fingerprints.as_string(alone))
    assert fingerprints.likeness(again, among) == 1.0
