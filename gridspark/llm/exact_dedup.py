"""Exact deduplication by a 128-bit content hash with byte comparison inside each group.

Texts are equal when identical after replacing every run of ASCII white space
by one space. Defined results:

* a null text counts as empty, and empty texts are copies of each other;
* rows without an id never beat a row with one; where no row of a group has an
  id, ``keep_id`` is null and every such row stays;
* repeated rows (same id, same text) all carry ``kept``; ``deduplicate`` returns
  one of them;
* an empty table gives an empty result; texts of any length are taken whole; other
  columns, whatever their names, are never looked at and ``deduplicate`` hands them on.

Only the hashes of all rows and one copy of each distinct text per map task are
shuffled, so a group of copies of any size arrives as a few rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.session import materialise

WHITE_RUN = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_RUN, " ")


def decisions(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    content_hash: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``content_hash`` may be any function of the normalised text: texts that
    share a hash but differ in a byte are told apart.
    """
    texts = docs.select(
        F.col(id_column).alias("doc_id"), normalised(F.col(text_column)).alias("norm")
    ).withColumn("hash", content_hash(F.col("norm")))
    keyed = materialise(
        texts.select("doc_id", "hash", F.sha2("norm", 256).alias("text_sha256")), "exact-keys"
    )
    # Grouping by hash and text compares the bytes; copies collapse before the shuffle.
    variants = texts.groupBy("hash", "norm").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    groups = materialise(
        variants.groupBy("hash").agg(
            F.min("keep_id").alias("keep_id"),
            F.sum("group_size").alias("group_size"),
            F.count(F.lit(1)).alias("variants"),
        ),
        "exact-groups",
    )
    collided = groups.filter("variants > 1").select("hash")
    # Reading both sides from tables lets adaptive execution split a hot hash.
    found = keyed.join(groups.filter("variants = 1"), "hash").select(
        "doc_id", "keep_id", "group_size", "text_sha256"
    )
    if not collided.isEmpty():
        apart = materialise(
            texts.join(collided, "hash")
            .groupBy("hash", "norm")
            .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
            "exact-collisions",
        )
        found = found.unionByName(
            texts.join(apart, ["hash", "norm"]).select(
                "doc_id", "keep_id", "group_size", F.sha2("norm", 256).alias("text_sha256")
            )
        )
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row goes when an equal text has a smaller id, or when it repeats the id
    and text of a row that stays. Rows without an id stay only if no row with an
    id has their text.
    """
    found = materialise(decisions(docs, id_column, text_column), "exact-decisions")
    # As one struct the columns of ``docs`` clash with no name used here.
    rows = docs.select(F.struct("*").alias("row"))
    own_id = F.col("row")[id_column]
    gone = found.filter(~F.col("kept"))
    stays = rows.join(
        gone.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("gone")), own_id == F.col("gone"), "left_anti"
    )
    repeated = found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    odd = repeated.select(F.col("doc_id").alias("odd"))
    if not gone.filter("doc_id IS NULL").isEmpty() or not odd.isEmpty():
        digest = F.sha2(normalised(F.col("row")[text_column]), 256)
        stays = _rows_with_doubtful_ids(rows, found, odd, own_id, digest)
    return stays.select("row.*")


def _rows_with_doubtful_ids(
    rows: DataFrame, found: DataFrame, odd: DataFrame, own_id: Column, digest: Column
) -> DataFrame:
    """``deduplicate`` where ids repeat or are missing: the text's digest tells rows apart."""
    keys = found.filter("kept").select("doc_id", "text_sha256").distinct()
    stays = rows.join(keys, own_id.eqNullSafe(F.col("doc_id")) & (digest == F.col("text_sha256")), "left_semi")
    single = stays.join(odd, own_id == F.col("odd"), "left_anti")
    several = stays.join(odd, own_id == F.col("odd"), "left_semi")
    one = several.select("row", own_id.alias("id"), digest.alias("sha")).dropDuplicates(["id", "sha"])
    return single.unionByName(one.select("row"))
