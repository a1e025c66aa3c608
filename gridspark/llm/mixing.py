"""Mixing sources to target weights by Pareto order sampling.

Every source has a target in words. A document first gets the whole copies that
are certain, ``floor(target / source_size)``; the rest of the target is an
unequal-probability sample without replacement: documents are ranked by random
odds divided by inclusion odds (longer documents have higher odds, in proportion
to their size) and taken in that order while the target lasts. One more document
that fits best closes the gap.

The state of a source is one row (whole copies, cut in the order, closing
document), so documents are decided row by row and their texts are never
shuffled. The cut is found through two histograms of the order (256 and 65,536
parts) and a running sum over the few rows of one part, however hot the source.

Defined results: a null text has size 0 and is taken 0 words; null sources are
one source, ordered last; rows without an id take part, ordered before others;
repeated rows are decided alike, and taken only where all of them fit the target;
an empty table gives an empty result. Texts of any length are taken whole, and
columns of any name are handed on. The same seed and rows give the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.session import materialise

PARTS = 256
MOST_COPIES = 3
WORD = r"[^\x20\x09-\x0D]+"
NO_ID = -(2**63)


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def source_key(source: Column) -> Column:
    """A join key that keeps null apart from every name."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def random_unit(doc_id: Column, seed: int) -> Column:
    """A number inside (0, 1), fixed by id and seed: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws("/", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit(""))))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    return (bits + F.lit(0.5)) / F.lit(float(2**52))


def place(size: Column, unit: Column, part: Column, mean: Column) -> Column:
    """Place in the Pareto order, squeezed from (0, inf) into (0, 1); null where not sampled."""
    odds = (part / (1 - part)) * (size / mean)
    q = (unit / (1 - unit)) / odds
    return F.when((part > 0) & (size > 0), q / (1 + q))


def source_targets(sized: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """One row per source: key, source_size, docs, target.

    Sources weigh 1, 2, 3, repeating in code-point order. The targets share all
    words by weight; a target above ``most`` times its source is cut there and
    the excess reshared, until none is above. Sorted by the level at which each
    source reaches its limit, the level of the uncut ones is a running sum.
    """
    sizes = sized.groupBy("key").agg(
        F.first("source").alias("source"),
        F.sum("size").alias("source_size"),
        F.count(F.lit(1)).alias("docs"),
    )
    # One row per source, not per document, meets in these windows.
    ranked = sizes.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ).withColumn("weight", (F.col("rank") - 1) % 3 + 1)
    limit = (F.col("source_size") * most).alias("most")
    ranked = ranked.select("*", limit)
    order = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    total = F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(after)
    leveled = ranked.withColumn("level", level).withColumn(
        "cut", F.col("most") <= F.col("level") * F.col("weight")
    )
    uncut = F.when(~F.col("cut"), F.struct(F.col("most") / F.col("weight"), "rank", "level"))
    shared = F.min(uncut).over(everything)["level"]
    target = F.when(F.col("cut"), F.col("most").cast("double")).otherwise(shared * F.col("weight"))
    return leveled.select("key", "source_size", "docs", target.alias("target"))


def plan(docs: DataFrame, seed: int = 0, most: int = MOST_COPIES) -> DataFrame:
    """What decides a document of each source; one row per source.

    key, source_size, target, mean, whole, part and, for the sampled part, the
    last place taken (``cut_place``, ``cut_id``) and the closing document.
    """
    sized = materialise(
        docs.select(
            F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("id"),
            F.col("source"),
            source_key(F.col("source")).alias("key"),
            words(F.col("text")).alias("size"),
            random_unit(F.col("doc_id"), seed).alias("unit"),
        ),
        "mix-sizes",
    )
    targets = source_targets(sized, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = materialise(
        targets.withColumn("mean", F.col("source_size") / F.col("docs"))
        .withColumn("whole", F.floor(ratio))
        .withColumn("part", ratio - F.floor(ratio))
        .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")),
        "mix-sources",
    )
    placed = (
        sized.drop("source")
        .join(sources.select("key", "mean", "part", "need"), "key")
        .withColumn("place", place(F.col("size"), F.col("unit"), F.col("part"), F.col("mean")))
        .filter("place IS NOT NULL")
        .withColumn("fine", F.floor(F.col("place") * (PARTS * PARTS)))
        .withColumn("coarse", F.floor(F.col("fine") / PARTS))
        .select("key", "id", "size", "place", "fine", "coarse", "need")
    )
    placed = materialise(placed, "mix-places")
    coarse = _edge(placed, "coarse")
    fine = _edge(
        placed.drop("need").join(coarse, ["key", "coarse"]).withColumnRenamed("rest", "need"), "fine"
    )
    edge = placed.drop("need").join(fine.withColumnRenamed("rest", "need"), ["key", "fine"])
    running = F.sum("size").over(Window.partitionBy("key").orderBy("place", "id"))
    cut = (
        edge.withColumn("running", running)
        .filter(F.col("running") <= F.col("need"))
        .groupBy("key")
        .agg(
            F.max(F.struct("place", "id")).alias("cut"),
            F.max("running").alias("taken"),
        )
    )
    cuts = (
        fine.join(cut, "key", "left")
        .select(
            "key",
            F.col("fine").alias("edge"),
            F.coalesce(F.col("cut.place"), F.lit(-1.0)).alias("cut_place"),
            F.coalesce(F.col("cut.id"), F.lit(NO_ID)).alias("cut_id"),
            (F.col("rest") - F.coalesce(F.col("taken"), F.lit(0))).alias("gap"),
        )
    )
    cuts = materialise(cuts, "mix-cuts")
    # Repeated rows are taken together, so together they must fit.
    left_over = (
        placed.join(cuts, "key")
        .filter(~_before_cut() & (F.col("size") <= F.col("gap")))
        .groupBy("key", "place", "id", "gap")
        .agg(F.sum("size").alias("size"))
        .filter(F.col("size") <= F.col("gap"))
    )
    closing = left_over.groupBy("key").agg(
        F.max(F.struct("size", (-F.col("place")).alias("back"), "id")).alias("closing")
    )
    found = (
        sources.drop("need", "docs")
        .join(cuts.drop("gap"), "key", "left")
        .join(closing, "key", "left")
        .select("*", F.col("closing.id").alias("closing_id"), (-F.col("closing.back")).alias("closing_place"))
        .drop("closing")
    )
    # As a table its size is known: small enough it is broadcast, else a hot source is split.
    return materialise(found, "mix-plan")


def _edge(rows: DataFrame, part: str) -> DataFrame:
    """Per source, the part of the order in which the running words reach the need, and the rest there."""
    sums = rows.groupBy("key", part).agg(F.sum("size").alias("size"), F.first("need").alias("need"))
    running = F.sum("size").over(Window.partitionBy("key").orderBy(part))
    return (
        sums.withColumn("running", running)
        .filter(F.col("running") >= F.col("need"))
        .groupBy("key")
        .agg(F.min(F.struct(F.col(part), (F.col("need") - F.col("running") + F.col("size")).alias("rest"))).alias("at"))
        .select("key", F.col("at")[part].alias(part), F.col("at.rest").alias("rest"))
    )


def _before_cut() -> Column:
    fine = F.floor(F.col("place") * (PARTS * PARTS))
    return (fine < F.col("edge")) | (
        (fine == F.col("edge"))
        & (F.struct("place", "id") <= F.struct(F.col("cut_place"), F.col("cut_id")))
    )


def decided(docs: DataFrame, seed: int = 0, most: int = MOST_COPIES) -> DataFrame:
    """All columns of ``docs`` as the struct ``row``, with size, source_size, target and copies."""
    sources = plan(docs, seed, most)
    rows = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("id"),
        source_key(F.col("source")).alias("key"),
        words(F.col("text")).alias("size"),
        random_unit(F.col("doc_id"), seed).alias("unit"),
    )
    joined = rows.join(sources, "key").withColumn(
        "place", place(F.col("size"), F.col("unit"), F.col("part"), F.col("mean"))
    )
    closes = (F.col("id") == F.col("closing_id")) & (F.col("place") == F.col("closing_place"))
    more = F.coalesce(_before_cut(), F.lit(False)) | F.coalesce(closes, F.lit(False))
    copies = F.when(F.col("size") > 0, F.col("whole") + more.cast("bigint")).otherwise(F.lit(0))
    return joined.select("row", "size", "source_size", "target", copies.cast("bigint").alias("copies"))


def mix(docs: DataFrame, seed: int = 0, most: int = MOST_COPIES) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it."""
    taken = decided(docs, seed, most).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select(
        "row.*"
    )
