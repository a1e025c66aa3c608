"""Duplicate handling and key-based maintenance of row sets.

All of these rank rows inside a key with ``row_number() = 1``. Spark turns that
into a partial group limit before the shuffle, so a key holding a third of all
rows leaves every map task as a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.session import materialise

_RANK = "__rank"


def _one_per_key(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, ranked).filter(F.col(_RANK) == 1).drop(_RANK)


def first_rows(df: DataFrame, limit: int | None) -> DataFrame:
    """At most ``limit`` rows of an ordered table; all of them for None."""
    return df if limit is None else df.limit(limit)


def keep_first(df: DataFrame, key: str, order: list[str], within: tuple[str, ...] = ()) -> DataFrame:
    """First row per key. NULL keys never collide, so all their rows stay.

    ``order`` must identify a row; it also spreads the NULL-key rows. Rows that are
    dealt already by the columns ``within``, which equal keys share, are not shuffled again, and
    come out in the order of these columns.
    """
    alone = [F.when(F.col(key).isNull(), F.col(c)) for c in order]
    return _one_per_key(df, [*map(F.col, within), F.col(key), *alone], [F.col(c).asc() for c in order])


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row per key; NULL keys count as one key."""
    return _one_per_key(df, [F.col(k) for k in keys], [F.col(c).desc() for c in order])


def new_rows(target: DataFrame, incoming: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows an insert-or-ignore on ``key`` would add to ``target``.

    The incoming side is deduplicated before it meets the target. NULL keys are
    always new.
    """
    fresh = keep_first(incoming, key, order)
    return fresh.join(target.select(key), key, "left_anti").select(incoming.columns)


def insert_or_ignore(
    target: DataFrame, incoming: DataFrame, key: str, order: list[str]
) -> DataFrame:
    """``target`` with the new rows of ``incoming`` appended."""
    return target.unionByName(new_rows(target, incoming, key, order), allowMissingColumns=True)


def upsert(target: DataFrame, incoming: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """Replace-by-key: incoming rows win over stored ones, later ones over earlier.

    ``order`` names incoming columns that say which of two rows came later. The
    stored rows, one per key already, are only filtered: their size never meets a
    sort, and a small batch is broadcast to them. The caller writes the result to a
    new snapshot folder.
    """
    last = _one_per_key(incoming, [key], [F.col(c).desc_nulls_last() for c in order])
    replaced = last.select(key.alias("__key"))
    kept = target.join(replaced, key.eqNullSafe(F.col("__key")), "left_anti")
    return kept.unionByName(last, allowMissingColumns=True)


def dense_ids(df: DataFrame, key: str, name: str = "id", start: int = 1) -> DataFrame:
    """Consecutive ids in the order of a unique integer ``key`` (eager: reads its input once).

    Rows are dealt by ranges of the key and counted off inside each; the rows in the
    ranges before are a running sum over one row per range, however sparse the
    keys are. Same input, same ids, whatever the partitioning.
    """
    dealt = materialise(df, "ids").repartitionByRange(key).sortWithinPartitions(key)
    placed = materialise(dealt.withColumn("__at", F.monotonically_increasing_id()), "ids-placed")
    # The upper bits of such an id number the range, the lower ones the row in it.
    ranges = placed.withColumn("__range", F.shiftright("__at", 33))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("__range")
        .agg(F.count("*").alias("__n"))
        .select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    )
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ranges.join(F.broadcast(offsets), "__range")  # one row per range
        .withColumn(name, F.col("__before") + inside + F.lit(start))
        .drop("__range", "__at", "__before")
    )
