"""Removal of personal data and of the terms that give it away, by corpus co-occurrence.

Two kinds of spans are found:

* base spans by pattern: e-mail and IP addresses, card and phone numbers;
* terms (runs of letters, in lower case) that reveal a protected entity of their
  document, that is the value of a base span. Counted over all documents, ``d``,

      share of the entity's information = PMI(term, entity) / IC(entity)
                                        = 1 - log(n_term / n_both) / log(d / n_entity),

  where ``n_both`` counts documents with the term near the entity. From a share
  of 1 - 1/5 on a term is generalised, from 1 - 1/20 on it is removed, wherever
  it stands in a document of that entity, but for base spans. A term needs
  ``support`` documents near its entity: one alone is no evidence of co-occurrence.
  Documents without personal data are left alone.

The shares are compared as products of quotients, (n_term / n_both)^5 <= d /
n_entity, so no logarithm's last digit decides.

All work is JVM-side. Only counts are shuffled: (entity, term) pairs and words,
both added up in the map task first. Documents meet the revealing terms through a
sketch of fixed size (a hashed set that lets a few other terms pass) and only the
positions that pass are joined with the entities' terms themselves. Patterns never back up
over what they took, so their time is linear in the text.

Defined results: a null text is empty; repeated rows are documents of their own
and each gets its row; rows without an id get theirs; an empty table gives no
rows; texts of any length are taken whole; columns other than the id and the text
are never looked at (``sanitised`` hands them on).
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.session import materialise

# The kinds in their order and their patterns. A match starts where
# a run of its characters starts or the match before ended, which says the same as
# trying every place but costs one try a run.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
# What a text must hold for a pattern to be tried.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]"}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IP_IN_RANGE = rf"^{PART}\.{PART}\.{PART}\.{PART}$"
GENERALISED, REMOVED = "generalised", "removed"
KINDS = [*BASE, GENERALISED, REMOVED]

WORD = r"[\p{L}\p{M}]+"
LEAST_CHARS = 3
# Characters on either side of a base span that count as near.
NEAR_CHARS = 100
SUPPORT = 2
# A share of 1 - 1/n or more.
GENERALISE, REMOVE = 5, 20
# Matches that one step of a fold copies at most.
FOLD_BLOCK = 200
# Places of the sketch for each term, and at most (one byte a place).
PLACES_PER_TERM, MOST_PLACES = 16, 1 << 24

SPANS = "array<struct<start:int,end:int,value:string>>"


def _none(kind: str = SPANS) -> Column:
    return F.array().cast(kind)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """True where the check digit of a digit string fits."""
    n = F.length(digits)

    def worth(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), n), worth), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return value.rlike(IP_IN_RANGE)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    """One spelling of an entity's value."""
    same = {"email": F.lower(value), "ip": value}.get(kind)
    return F.concat(F.lit(f"{kind}:"), _digits(value) if same is None else same)


def _located(gaps: Column, found: Column, wanted) -> Column:
    """The ``wanted`` matches with their places, from the texts between all matches.

    The list grows by blocks, so that a step copies a short list only.
    """
    n = F.size(found)
    steps = F.zip_with(
        F.slice(gaps, F.lit(1), n), found, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("value"))
    )

    def state(at: Column, out: Column) -> Column:
        return F.struct(at.alias("at"), out.cast(SPANS).alias("out"))

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + s["gap"]
        end = start + F.length(s["value"])
        span = F.struct(start.alias("start"), end.alias("end"), s["value"].alias("value"))
        return state(end, F.when(wanted(s["value"]), F.concat(acc["out"], F.array(span))).otherwise(acc["out"]))

    def block(acc: Column, rows: Column) -> Column:
        return F.aggregate(
            rows, state(acc["at"], _none()), step, lambda own: state(own["at"], F.concat(acc["out"], own["out"]))
        )

    blocks = F.transform(F.sequence(F.lit(1), n, F.lit(FOLD_BLOCK)), lambda k: F.slice(steps, k, FOLD_BLOCK))
    return F.when(n > 0, F.aggregate(blocks, state(F.lit(0), _none()), block, lambda acc: acc["out"])).otherwise(_none())


def _matches(rows: DataFrame) -> DataFrame:
    """``rows`` with, for each base kind, all matches in ``text`` and the texts between them."""
    text = F.col("text")
    for kind, pattern in BASE.items():
        hint = text.contains("@") if kind == "email" else text.rlike(HINTS[kind])
        found = F.when(hint, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        rows = rows.withColumn(f"{kind}_found", F.coalesce(found, _none("array<string>")))
        gaps = F.when(F.size(f"{kind}_found") > 0, F.split(text, pattern, -1)).otherwise(F.array(text))
        rows = rows.withColumn(f"{kind}_gaps", gaps)
    return rows


def with_base_spans(rows: DataFrame) -> DataFrame:
    """``rows`` with a list of valid spans (start, end, value) of each base kind in ``text``."""
    spans = {
        kind: _located(F.col(f"{kind}_gaps"), F.col(f"{kind}_found"), partial(_valid, kind))
        for kind in BASE
    }
    return _matches(rows).withColumns(spans).drop(*[f"{k}_{what}" for k in BASE for what in ("found", "gaps")])


def _terms(words: Column) -> Column:
    """Words as terms, each once."""
    return F.array_distinct(F.transform(F.filter(words, lambda w: F.length(w) >= LEAST_CHARS), F.lower))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _near(kind: str, near_chars: int) -> Column:
    """For each valid span of a kind its entity and the terms on either side."""
    gaps, found = F.col(f"{kind}_gaps"), F.col(f"{kind}_found")

    def side(gap: Column, before: bool) -> Column:
        cut = F.substring(gap, -near_chars, near_chars) if before else F.substring(gap, 1, near_chars)
        # A word that the cut went through does not count, nor do parts of addresses.
        whole = F.regexp_replace(cut, r"^[^\x20\x09-\x0D]+" if before else r"[^\x20\x09-\x0D]+$", "")
        return F.regexp_replace(F.when(F.length(gap) > near_chars, whole).otherwise(gap), EMAIL, " ")

    def pairs(i: Column) -> Column:
        value = F.element_at(found, i)
        around = F.concat_ws(" ", side(F.element_at(gaps, i), True), side(F.element_at(gaps, i + 1), False))
        terms = F.concat(F.array(F.lit("")), _terms(_words(around)))
        entity = _entity(kind, value)
        named = F.transform(terms, lambda t: F.struct(entity.alias("entity"), t.alias("term")))
        return F.when(_valid(kind, value), named)

    each = F.transform(F.sequence(F.lit(1), F.size(found)), pairs)
    kept = F.filter(each, lambda p: p.isNotNull())
    return F.when(F.size(found) > 0, F.flatten(kept)).otherwise(_none("array<struct<entity:string,term:string>>"))


def revealing_terms(
    texts: DataFrame,
    near_chars: int = NEAR_CHARS,
    support: int = SUPPORT,
    generalise: int = GENERALISE,
    remove: int = REMOVE,
) -> DataFrame:
    """Terms that disclose too much of an entity: entity, term, level (1 generalise, 2 remove).

    ``texts`` has a column ``text`` without nulls (eager; read three times).
    """
    # The empty term counts the documents of an entity itself.
    found = _matches(texts.select("text")).filter(
        reduce(lambda a, b: a | b, [F.size(f"{k}_found") > 0 for k in BASE])
    )
    pairs = F.array_distinct(F.concat(*[_near(kind, near_chars) for kind in BASE]))
    both = materialise(
        found.select(F.explode(pairs).alias("p"))
        .groupBy("p.entity", "p.term")
        .agg(F.count(F.lit(1)).alias("n_both"))
        .filter(F.col("n_both") >= support),
        "sanitise-pairs",
    )
    entities = both.filter("term = ''").select("entity", F.col("n_both").alias("n_entity"))
    words = (
        texts.select(F.explode(_terms(_words(F.col("text")))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n_term"))
    )
    counted = both.filter("term <> ''").join(entities, "entity").join(words, "term")
    rare = F.lit(texts.count()).cast("double") / F.col("n_entity")
    odds = F.greatest(F.col("n_term"), F.col("n_both")).cast("double") / F.col("n_both")

    def reaches(n: int) -> Column:
        return (rare > 1) & (reduce(lambda a, b: a * b, [odds] * n) <= rare)

    level = F.when(reaches(remove), 2).when(reaches(generalise), 1)
    leveled = counted.withColumn("level", level).filter("level IS NOT NULL")
    return materialise(leveled.select("entity", "term", "level"), "sanitise-terms")


def _sketch(terms: DataFrame) -> tuple[bytes, int]:
    """A byte for each place that a term hashes to: fixed in size however many terms (eager)."""
    terms = terms.select("term").distinct()
    places = 1 << max(12, (PLACES_PER_TERM * terms.count()).bit_length())
    places = min(places, MOST_PLACES)
    marks = bytearray(places)
    for row in terms.select(_place(F.col("term"), places).alias("at")).distinct().toLocalIterator():
        marks[row["at"]] = 1
    return bytes(marks), places


def _place(term: Column, places: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(places)).cast("int")


def _marked(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """``rows`` (without ``text``) numbered by ``rid``, with base spans and a list ``told`` of term spans (eager)."""
    marks, places = _sketch(terms)

    def may_tell(word: Column) -> Column:
        mark = F.substring(F.lit(marks), _place(F.lower(word), places) + 1, F.lit(1))
        return (F.length(word) >= LEAST_CHARS) & (mark == F.lit(b"\x01"))

    def entities(kind: str) -> Column:
        return F.transform(kind, lambda s: _entity(kind, s["value"]))

    based = with_base_spans(rows).withColumn("who", F.array_distinct(F.concat(*[entities(k) for k in BASE])))
    words = F.when(F.size("who") > 0, _words(F.col("text"))).otherwise(_none("array<string>"))
    based = based.withColumn("words", words)
    some = F.exists("words", may_tell)
    maybe = F.when(some, _located(F.split("text", WORD, -1), F.col("words"), may_tell)).otherwise(_none())
    taken = F.concat(*[F.col(k) for k in BASE])
    outside = F.filter(
        maybe, lambda s: ~F.exists(taken, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )
    numbered = materialise(
        based.withColumn("maybe", outside).drop("text", "words").withColumn("rid", F.monotonically_increasing_id()),
        "sanitise-rows",
    )
    open_rows = numbered.filter(F.size("maybe") > 0)
    levels = (
        open_rows.select("rid", F.explode("who").alias("entity"))
        .join(terms, "entity")
        .groupBy("rid", "term")
        .agg(F.max("level").alias("level"))
    )
    told = materialise(
        open_rows.select("rid", F.explode("maybe").alias("s"))
        .withColumn("term", F.lower("s.value"))
        .join(levels, ["rid", "term"])
        .groupBy("rid")
        .agg(F.collect_list(F.struct("s.start", "s.end", "s.value", "level")).alias("told")),
        "sanitise-told",
    )
    empty = _none("array<struct<start:int,end:int,value:string,level:int>>")
    plain = numbered.filter(F.size("maybe") == 0).withColumn("told", empty)
    met = open_rows.join(told, "rid", "left").withColumn("told", F.coalesce("told", empty))
    return plain.unionByName(met).drop("maybe", "who")


def _listed(kinds: dict[str, Column]) -> Column:
    """``kind:start:end`` of all spans by start, then kind in the order of ``KINDS``."""

    def ranked(kind: str):
        rank = F.lit(KINDS.index(kind)).alias("k")
        return lambda s: F.struct(s["start"].alias("a"), rank, s["end"].alias("z"))

    parts = [F.transform(spans, ranked(kind)) for kind, spans in kinds.items()]
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.concat(*parts))
    return F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["k"] + 1), s["a"], s["z"])), ","
    )


def _texts(docs: DataFrame, text_column: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))


def spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **limits) -> DataFrame:
    """Where personal data and the terms that reveal it are, one row per document.

    doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_generalised,
    n_removed. ``limits`` are those of ``revealing_terms``.
    """
    terms = revealing_terms(_texts(docs, text_column), **limits)
    text = F.coalesce(F.col(text_column), F.lit("")).alias("text")
    rows = _marked(docs.select(F.col(id_column).alias("doc_id"), text), terms)
    base = {k: F.col(k) for k in BASE}
    told = {
        GENERALISED: F.filter("told", lambda s: s["level"] == 1),
        REMOVED: F.filter("told", lambda s: s["level"] == 2),
    }
    return rows.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in BASE],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(base | told).alias("spans"),
        *[F.size(s).cast("bigint").alias(f"n_{k}") for k, s in told.items()],
    )


def _without(text: Column, spans: Column, name) -> Column:
    """``text`` with each span replaced by its ``name``; of overlapping spans the first counts."""
    ordered = F.array_sort(spans)

    def step(acc: Column, s: Column) -> Column:
        fits = s["start"] >= acc["at"]
        kept = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.when(fits, s["end"]).otherwise(acc["at"]).alias("at"),
            F.when(fits, F.concat(acc["out"], F.array(kept, name(s)))).otherwise(acc["out"]).alias("out"),
        )

    none = F.struct(F.lit(0).alias("at"), _none("array<string>").alias("out"))

    def last(acc: Column) -> Column:
        return F.array_join(F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, F.length(text)))), "")

    return F.when(F.size(spans) > 0, F.aggregate(ordered, none, step, last)).otherwise(text)


def sanitised(docs: DataFrame, text_column: str = "text", **limits) -> DataFrame:
    """``docs`` with personal data and revealing terms taken out of the text; other columns as they are.

    A base span becomes ``<email>`` and so on, a generalised term ``<name>`` if it
    has a capital and ``<word>`` otherwise; a removed term leaves nothing. Where
    spans overlap, the one that starts first counts. A null text becomes empty.
    """
    terms = revealing_terms(_texts(docs, text_column), **limits)
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = _marked(docs.select(F.struct("*").alias("row"), text.alias("text"), text.alias("whole")), terms)

    def named(kind):
        return lambda s: F.struct(
            s["start"].alias("start"), kind(s).alias("kind"), s["end"].alias("end"), s["value"].alias("value")
        )

    def constant(kind: str):
        return named(lambda _: F.lit(kind))

    base = [F.transform(k, constant(k)) for k in BASE]
    told = F.transform("told", named(lambda s: F.when(s["level"] == 2, REMOVED).otherwise(GENERALISED)))

    def name(s: Column) -> Column:
        wider = F.when(s["value"] != F.lower(s["value"]), "<name>").otherwise("<word>")
        return (
            F.when(s["kind"] == REMOVED, "")
            .when(s["kind"] == GENERALISED, wider)
            .otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">")))
        )

    clean = rows.select("row", _without(F.col("whole"), F.concat(*base, told), name).alias("clean"))
    return clean.select(
        *[F.col("clean").alias(c) if c == text_column else F.col("row")[c].alias(c) for c in docs.columns]
    )
