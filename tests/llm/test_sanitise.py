import hashlib
import re

import pytest
import regex

from gridspark.llm import sanitise
from tests.llm.helpers import LONG, documents

# The contract's patterns as they stand.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
PATTERNS = {
    "email": EMAIL,
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "generalised", "removed"]


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 10 <= len(digits) <= 15


def base(text):
    return [
        (m.start(), kind, m.end(), m.group())
        for kind in PATTERNS
        for m in re.finditer(PATTERNS[kind], text)
        if valid(kind, m.group())
    ]


def words(text):
    return [(*m.span(), m.group()) for m in regex.finditer(r"[\p{L}\p{M}]+", text)]


def entity(kind, value):
    return f"{kind}:" + {"email": value.lower(), "ip": value}.get(kind, re.sub("[^0-9]", "", value))


def terms(text):
    return {w.lower() for _, _, w in words(text) if len(w) >= 3}


def brute(texts):
    """base and all spans of each text, by counting documents one by one."""
    near, whose, holds = {}, {}, {}
    for n, text in enumerate(texts):
        for t in terms(text):
            holds.setdefault(t, set()).add(n)
        for kind in PATTERNS:
            matches = list(re.finditer(PATTERNS[kind], text))
            edges = [0, *[e for m in matches for e in m.span()], len(text)]
            gaps = [text[edges[2 * i] : edges[2 * i + 1]] for i in range(len(matches) + 1)]
            for i, m in enumerate(matches):
                if not valid(kind, m.group()):
                    continue
                left, right = gaps[i], gaps[i + 1]
                if len(left) > 100:
                    left = re.sub(r"^[^\x20\x09-\x0D]+", "", left[-100:])
                if len(right) > 100:
                    right = re.sub(r"[^\x20\x09-\x0D]+\Z", "", right[:100])
                e = entity(kind, m.group())
                whose.setdefault(e, set()).add(n)
                for t in terms(re.sub(EMAIL, " ", left) + " " + re.sub(EMAIL, " ", right)):
                    near.setdefault((e, t), set()).add(n)
    level = {}
    for (e, t), both in near.items():
        rare = len(texts) / len(whose[e])
        odds = max(len(holds.get(t, ())), len(both)) / len(both)
        if len(both) >= 2 and rare > 1 and odds**5 <= rare:
            level[e, t] = 2 if odds**20 <= rare else 1
    out = []
    for text in texts:
        found = base(text)
        own = {entity(kind, value) for _, kind, _, value in found}
        told = []
        for a, b, w in words(text):
            n = max((level.get((e, w.lower()), 0) for e in own), default=0)
            if n and not any(s < b and a < z for s, _, z, _ in found):
                told.append((a, KINDS[3 + n], b))
        every = sorted([(a, KINDS.index(k), z) for a, k, z in [s[:3] for s in found] + told])
        listed = [f"{KINDS[k]}:{a}:{z}" for a, k, z in every]
        first = [f"{KINDS[k]}:{a}:{z}" for a, k, z in every if k < 4]
        out.append((hashlib.sha256(",".join(first).encode()).hexdigest(), ",".join(listed)))
    return out


TEXTS = [
    "Reach Zebulon at zeb@mail.example.com or +1 (200) 555-0199 today, the office is open.",
    "The office of Zebulon: zeb@mail.example.com.",
    "the office is far from here",
    "the office again, 10.0.0.256 and 10.0.0.255 and 0010.1.2.3.4",
    "a@b@c.d x@y.z.. x@y .@-.- a@b.c_d@e.f +-%@Z.Z9",
    "1.2.3.4.5.6.7.8 999.1.1.1 1..2 1.2.3.99999999999999999999999",
    "cards 4111 1111 1111 1111, 4111-1111-1111-1112 and 4111111111111111 4 79927398713 30569309025904",
    "phones +1 555 0100 123 +44((((( +49 (0)30 123456-78 +1 2 +12345678901234567 ++1 (017) 555-7713.",
    "\U0001f600é zeb@mail.example.com ÉTUDE Zebulon ñandú",
    "\U0001f600é zeb@mail.example.com ÉTUDE Zebulon ñandú",
    "ÉTUDE alone, Zebulon alone",
    "1234567890 " * 40,
    "a" * 50_000 + "@" + "b." * 20_000 + " " + "1" * 30_000 + "." * 9 + "+1" + "(" * 30_000,
    " ".join(f"u{i}@h{i}.org" for i in range(700)),
    "",
    "   ",
    None,
    LONG,
]


def table(spark, texts):
    return documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])


def test_against_brute_force(spark):
    rows = sorted(sanitise.spans(table(spark, TEXTS)).collect(), key=lambda r: r["doc_id"])
    want = brute([t or "" for t in TEXTS])
    assert [(r["base_sha256"], r["spans"]) for r in rows] == want
    assert any("removed" in s for _, s in want) and any("generalised" in s for _, s in want)
    for r, text in zip(rows, TEXTS):
        kinds = [k for _, k, _, _ in base(text or "")]
        assert [r[f"n_{k}"] for k in PATTERNS] == [kinds.count(k) for k in PATTERNS]


def test_repeated_rows_and_missing_ids(spark):
    said = "Zebulon: zeb@mail.example.com"
    rows = [(None, said, "en", "a"), (None, said, "en", "a"), (1, said, "en", "a"), (1, said, "en", "a"), (2, "x", None, None)]
    got = sanitise.spans(documents(spark, rows)).collect()
    assert len(got) == 5
    assert {r["spans"] for r in got if r["doc_id"] != 2} == {"removed:0:7,email:9:29"}


def test_a_hot_entity_reveals_nothing(spark):
    got = sanitise.spans(table(spark, ["Zebulon zeb@mail.example.com"] * 6)).collect()
    assert {r["spans"] for r in got} == {"email:8:28"}


def test_empty_table(spark):
    assert sanitise.spans(table(spark, ["x"]).limit(0)).collect() == []


def test_sanitised_texts(spark):
    got = sanitise.sanitised(table(spark, TEXTS))
    assert got.columns == table(spark, TEXTS).columns
    clean = {r["doc_id"]: r["text"] for r in got.collect()}
    assert clean[2] == TEXTS[2] and clean[16] == "" and clean[17] == LONG
    assert clean[1] == "The office of <name>: <email>."
    assert "<ip>" in clean[3] and "10.0.0.256" in clean[3]
    assert clean[8] == "\U0001f600é <email> ÉTUDE <name> "


@pytest.mark.parametrize("text", ["a" * 200_000, "1 " * 100_000, "+1" * 100_000, "a@" * 100_000, "a.b@c." * 30_000, "1." * 100_000])
def test_patterns_are_linear(spark, text):
    rows = sanitise.with_base_spans(spark.createDataFrame([(text,)], "text string")).collect()
    assert len(rows) == 1
