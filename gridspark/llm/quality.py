"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its text. Preference pairs, a
document marked good over one marked bad, teach the weights by logistic loss on
the difference of their features. Strengths are then cut at a quantile: the
share of bad documents among the labelled ones. The score is the logistic of the
distance to that cut, set so that the cut scores ``CUT_SCORE``.

The fit uses every labelled document. Up to ``BLOCK_ROWS`` of them are ranked at
once; more are dealt to blocks of about so many, each with good and bad ones, whose
pairs tasks compare: a Newton step is one sum over the blocks, the spread of the
features and the quantile are counted over all rows. The strengths of all documents
are column expressions.

Defined results: null and empty texts have all features zero and a defined
score; labels that are null, held out or without a document are not used, and a
document with contradicting labels counts as bad, and of several texts of one
labelled id the first in order is learnt from; where the labels show only one
side nothing can be ranked and every document scores ``CUT_SCORE``; an empty
table gives an empty result. Repeated documents score alike. Texts of any length
are taken whole; columns of any other name are handed on or not looked at.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.operators.rowsets import dense_ids
from gridspark.session import materialise

# Labelled documents whose pairs are compared together, as feature rows.
BLOCK_ROWS = 4096
# Good documents that each bad one is compared with, at least.
OPPONENTS = 24
# Exact sums: they do not depend on the order in which tasks end.
EXACT = "decimal(38,15)"
# Ranges of strengths that are counted at once in search of a quantile.
RANGES = 1024
PENALTY = 1e-3
FOLDS = 5
CUT_SCORE = 0.3


def features(text: Column) -> dict[str, Column]:
    """Numbers of the text alone, roughly within [0, 1]."""
    text = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(text), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / chars

    tokens = F.split(F.lower(text), " ")
    n_tokens = F.size(tokens)
    distinct = F.size(F.array_distinct(tokens))
    upper = share(r"\p{Lu}")
    symbols = share(r"[^\p{L}\p{N}\s.,;:'!?|-]")
    marks = share(r"!")
    bars = share(r"\|")
    stops = share(r"[.?]")
    return {
        "upper": upper,
        "shouting": F.least(upper * 3, F.lit(1.0)),
        "symbols": symbols,
        "some_symbols": F.sqrt(symbols),
        "marks": F.sqrt(marks),
        "bars": F.sqrt(bars),
        "stops": F.sqrt(stops),
        "digits": F.sqrt(share(r"\p{N}")),
        "richness": F.log(distinct + F.lit(1.0)) / F.log(n_tokens + F.lit(1.0)),
        "distinct": distinct / n_tokens,
        "token_length": chars / n_tokens / 50,
        "length": F.log(chars.cast("double")) / 12,
        "lines": F.sqrt(share(r"\n")),
    }


@dataclasses.dataclass(frozen=True)
class Ranking:
    """Weights of the features and the strength at the cut."""

    weights: dict[str, float]
    cut: float

    def score(self, text: Column) -> Column:
        strength = sum((F.lit(w) * f for w, f in self._terms(text)), F.lit(-self.cut))
        return 1 / (1 + F.exp(-(strength + F.lit(math.log(CUT_SCORE / (1 - CUT_SCORE))))))

    def _terms(self, text: Column) -> list[tuple[float, Column]]:
        columns = features(text)
        return [(w, columns[name]) for name, w in self.weights.items()]


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents, by the CRC-32 of the id as text, never taught from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, block_rows: int = BLOCK_ROWS) -> Ranking:
    """Learn from ``labels`` (doc_id, quality) of ``docs`` (doc_id, text) outside the held-out fold."""
    names = list(features(F.col("text")))
    rows = _examples(docs, labels)
    good, bad = rows.agg(F.count_if("good"), F.count_if(~F.col("good"))).first()
    if good + bad > block_rows and good and bad:
        return _rank_blocks(rows, good, bad, names, block_rows)
    # At most ``block_rows`` rows of numbers, or the labels show one side only.
    local = rows.limit(block_rows).select("good", *names).toPandas()
    quality = local.pop("good").to_numpy().astype(int)
    table = local.to_numpy(dtype=float)
    order = np.lexsort([*table.T, quality])  # the fit must not depend on the order of arrival
    return rank(table[order], quality[order], names)


def _examples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """label_id, good and the features of each labelled document, once an id (eager).

    The texts become numbers before they meet the labels, so that no text is shuffled.
    Only ids that come more than once are looked up again, for the first of their texts.
    """
    taught = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg((F.min("quality") == 1).alias("good"))
    )
    named = [c.alias(n) for n, c in features(F.col("text")).items()]
    texts = docs.select(F.col("doc_id").alias("label_id"), "text").filter(
        F.col("label_id").isNotNull() & ~held_out(F.col("label_id"))
    )
    rows = materialise(texts.select("label_id", *named).join(taught, "label_id"), "quality-rows")
    repeated = materialise(
        rows.groupBy("label_id", "good").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "quality-repeated"
    )
    if repeated.isEmpty():
        return rows
    firsts = texts.join(repeated, "label_id").groupBy("label_id", "good").agg(F.min("text").alias("text"))
    once = rows.join(repeated, "label_id", "left_anti")
    return materialise(once.unionByName(firsts.select("label_id", "good", *named)), "quality-examples")


def rank(table: np.ndarray, quality: np.ndarray, names: list[str]) -> Ranking:
    """Bradley-Terry weights of feature rows with 0/1 labels."""
    bad = np.count_nonzero(quality != 1)
    if not bad or bad == len(quality):
        return Ranking(dict.fromkeys(names, 0.0), 0.0)
    spread = table.std(axis=0)
    spread[spread < 1e-9] = 1.0
    scaled = table / spread
    difference = _pairs(scaled, quality)
    weights = _newton(lambda w: _mean(_sums(difference, w), w), len(names))
    ordered = np.sort(scaled @ weights)
    # The quantile of the share of bad documents.
    cut = (ordered[bad - 1] + ordered[min(bad, len(ordered) - 1)]) / 2
    return Ranking(dict(zip(names, (weights / spread).tolist())), float(cut))


def _pairs(scaled: np.ndarray, quality: np.ndarray) -> np.ndarray:
    """Features of good minus bad documents: each bad one ``OPPONENTS`` times, and every good one."""
    good, bad = np.flatnonzero(quality == 1), np.flatnonzero(quality != 1)
    opponents = max(min(OPPONENTS, len(good)), -(-len(good) // len(bad)))
    loser = np.repeat(bad, opponents)
    stride = 7919 if len(good) % 7919 else 7927  # no divisor, so that all good ones come up
    return scaled[good[(np.arange(len(loser)) * stride) % len(good)]] - scaled[loser]


def _sums(difference: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of the logistic loss over pairs: their number, the loss, its slope and its curvature."""
    won = difference @ weights
    lost = 1 / (1 + np.exp(np.clip(won, -500, 500)))
    curvature = (difference * (lost * (1 - lost))[:, None]).T @ difference
    return np.concatenate([[len(won), np.logaddexp(0, -won).sum()], -(lost @ difference), curvature.ravel()])


def _mean(sums: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean loss, slope and curvature with the penalty |w|^2 / 2 on the weights."""
    k = len(weights)
    mean = sums[1:] / sums[0]
    loss = mean[0] + PENALTY * weights @ weights / 2
    return loss, mean[1 : k + 1] + PENALTY * weights, mean[k + 1 :].reshape(k, k) + PENALTY * np.eye(k)


def _newton(at: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]], k: int, steps: int = 30) -> np.ndarray:
    """Weights of the least loss; ``at`` gives loss, slope and curvature."""
    weights = np.zeros(k)
    loss, slope, curvature = at(weights)
    for _ in range(steps):
        step = np.linalg.solve(curvature, slope)
        size, ahead = 1.0, at(weights - step)
        while size > 1e-6 and ahead[0] > loss + 1e-12:
            size /= 2
            ahead = at(weights - size * step)
        weights = weights - size * step
        loss, slope, curvature = ahead
        if np.abs(size * step).max() < 1e-7:  # the next one would be of the order of its square
            break
    return weights


def _rank_blocks(rows: DataFrame, good: int, bad: int, names: list[str], block_rows: int) -> Ranking:
    """The same as ``rank`` over blocks of rows; the driver sees sums only."""
    total = good + bad
    mean = _exact_sums(rows, [F.col(n) for n in names]) / total
    square = _exact_sums(rows, [F.pow(F.col(n) - F.lit(m), F.lit(2)) for n, m in zip(names, mean.tolist())])
    spread = np.sqrt(square / total)
    spread[spread < 1e-9] = 1.0
    blocks = _blocks(rows, good, bad, names, -(-total // block_rows))
    width = 2 + len(names) + len(names) ** 2
    schema = ", ".join(f"s{i} double" for i in range(width))

    def at(weights: np.ndarray):
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    members = batch.column("members").slice(i, 1).flatten()
                    quality = members.field("good").to_numpy(zero_copy_only=False).astype(int)
                    table = np.stack([members.field(n).to_numpy(zero_copy_only=False) for n in names], axis=1)
                    sums = _sums(_pairs(table / spread, quality), weights)
                    yield pa.RecordBatch.from_arrays([pa.array([s]) for s in sums], names=[f"s{j}" for j in range(width)])

        return _mean(_exact_sums(blocks.mapInArrow(part, schema), [F.col(f"s{i}") for i in range(width)]), weights)

    weights = _newton(at, len(names)) / spread
    strength = sum((F.lit(w) * F.col(n) for n, w in zip(names, weights.tolist())), F.lit(0.0))
    return Ranking(dict(zip(names, weights.tolist())), _between(rows.select(strength.alias("strength")), bad))


def _exact_sums(rows: DataFrame, values: list[Column]) -> np.ndarray:
    return np.array([float(s) for s in rows.agg(*[F.sum(v.cast(EXACT)) for v in values]).first()])


def _blocks(rows: DataFrame, good: int, bad: int, names: list[str], n: int) -> DataFrame:
    """``members`` (good, features) of ``n`` blocks, every row in one at least.

    Either side is dealt in turn, in the order of a digest. Of a side that is too small
    for all blocks to get ``OPPONENTS`` good documents, or a bad one, rows go to several.
    """
    key = F.struct("good", F.xxhash64("label_id").alias("digest"), "label_id")
    numbered = dense_ids(rows.withColumn("key", key), "key", "number", start=0)

    def dealt(number: Column, count: int, least: int) -> Column:
        if count >= n * least:
            return F.array(number % n)
        least = min(least, count)
        slots = F.sequence(number, F.lit(n * least - 1).cast("bigint"), F.lit(count).cast("bigint"))
        return F.transform(slots, lambda s: F.floor(s / least))

    # Bad rows come first in the order of the key.
    number = F.col("number").cast("bigint")
    block = F.when(F.col("good"), dealt(number - bad, good, OPPONENTS)).otherwise(dealt(number, bad, 1))
    members = numbered.select(F.explode(block).alias("block"), F.struct("good", *names).alias("member"))
    return materialise(
        members.groupBy("block").agg(F.sort_array(F.collect_list("member")).alias("members")), "quality-blocks"
    )


def _between(strengths: DataFrame, below: int) -> float:
    """The middle between the ``below``-th least of ``strengths`` and the next one."""
    value, left = F.col("strength"), below
    low, high = strengths.agg(F.min(value), F.max(value)).first()
    while low < high:
        at = F.least(F.floor((value - low) / (high - low) * RANGES), F.lit(RANGES - 1))
        ranges = strengths.filter(value.between(low, high)).groupBy(at.alias("at"))
        for found in ranges.agg(F.count(F.lit(1)).alias("n"), F.min(value), F.max(value)).orderBy("at").collect():
            if left <= found.n:
                low, high = found[2], found[3]
                break
            left -= found.n
    upto, following = strengths.agg(F.count_if(value <= low), F.min(F.when(value > low, value))).first()
    return (low + (low if upto > below else following)) / 2


def scored(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """doc_id, held_out, score and predicted of all ``docs``."""
    score = ranking.score(F.col("text"))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT_SCORE).cast("int")
    )


def keep_good(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """The rows of ``docs`` that the ranking does not reject, with all their columns."""
    return docs.filter(ranking.score(F.col("text")) >= CUT_SCORE)
