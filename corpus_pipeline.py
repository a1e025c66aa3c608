"""A corpus pipeline of five operators: quality, exact and near copies, mixing, packing.

Each stage takes what the one before kept, as a table; all but the last return
the columns of ``documents``. The mix repeats the rows it takes more than once.

Defined results, in every stage: null and empty texts are texts without words and
copies of each other; rows without an id go on as long as no row with an id has
their text; of repeated rows one is kept by the second stage; ties go to the
smallest id; an empty table stays empty; texts of any length are taken whole; more
columns, whatever their names, are handed on up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridspark.llm import exact_dedup, mixing, near_dedup, packing, quality, queries
from gridspark.session import materialise


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking learnt from ``labels`` does not reject."""
    return quality.keep_good(docs, quality.fit(docs, queries.table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.deduplicate(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_dedup.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in training sequences."""
    return packing.packed(docs, queries.tokenizer_file(), queries.PACK_END)


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("source_mix", mixed),
    ("packing", packed),
]

# A learnt ranking and a tokenizer are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each from the table that the one before wrote."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
