"""Ordered settlement of credit sales.

A sale is accepted when the credit still holds enough, and a rejected sale
takes nothing, so every decision depends on the ones before it. Two exact ways
share the work:

* A credit with few requests is folded: its requests, sorted, in one array.
* A credit with many requests is cut into slices that are folded side by side,
  each from a guessed balance. A fold also yields the interval of start balances
  under which none of its outcomes changes, and the net amount it takes. Chaining
  the slices of a credit gives the balance each one really starts with: where it
  lies in the interval the fold holds, with the end moved along; else the slice is
  folded again from there, and the chain goes on meanwhile from the end that the
  guess led to. A slice far into an exhausted credit mostly ends alike whatever
  the start, and one of a rich credit accepts all, so few passes suffice; a pass
  settles at least the first slice that was wrong. A chain has one step for a slice
  of about ``SLICE_ROWS`` requests or more, at most about ``MOST_SLICES`` a credit; no
  task or group holds such a credit whole, and a fold streams over blocks of requests.
  Requests are dealt once, into the order of their credit, and stored in blocks. A pass
  moves quantities only, and as the folds tell the balance before each block, the
  outcomes are told where a block lies: requests are neither dealt nor joined again.

Quantities are decimals with six places, so sums do not depend on their order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal, localcontext
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StructField, StructType

from gridspark.operators.credits import TOKEN_SHARE
from gridspark.session import materialise

# Result names.
SOLD = "venda_realizada"
UNKNOWN_CREDIT = "credito_inexistente"
TOO_LITTLE = "saldo_insuficiente"
INVALID = "quantidade_invalida"
KIND = "venda"

ORDER = ["data_transacao", "seq", "tie", "tie2"]
FOLD_LIMIT = 1000
# Requests of a slice at least, slices of a credit at most, requests of a block.
SLICE_ROWS = 500_000
MOST_SLICES = 100_000
BLOCK_ROWS = 20_000
CHUNK_ROWS = 1_000_000
FOLD_BLOCK = 100
# Blocks that are told their balance by a broadcast, at most; more are joined as Spark chooses.
MOST_TOLD = 100_000
# A task holds so many blocks of a file at once.
STORED_BLOCKS = {"parquet.block.row.count.limit": "8"}
QUANTITY = "decimal(28,6)"
BALANCE = "decimal(38,6)"


def _prepared(requests: DataFrame) -> DataFrame:
    token = F.lit(None).cast("double")
    if "valor_token" in requests.columns:
        token = F.col("valor_token")
    return requests.withColumns(
        {
            "q": F.col("quantidade_kwh").try_cast(QUANTITY),
            "valor_token": F.coalesce(token, F.col("valor_rs") * TOKEN_SHARE),
        }
    )


def _fold(requests: Column, balance: Column) -> Column:
    """Balance after the sorted ``requests`` and a text of 1 (fits) or 0 for each.

    The text grows by blocks, so that a step copies a short text only.
    """

    def state(left: Column, flags: Column) -> Column:
        return F.struct(left.cast(BALANCE).alias("left"), flags.alias("flags"))

    def step(acc: Column, req: Column) -> Column:
        fits = F.coalesce(acc["left"] >= req["q"], F.lit(False))
        left = F.when(fits, acc["left"] - req["q"]).otherwise(acc["left"])
        return state(left, F.concat(acc["flags"], F.when(fits, "1").otherwise("0")))

    def block(acc: Column, rows: Column) -> Column:
        return F.aggregate(
            rows,
            state(acc["left"], F.lit("")),
            step,
            lambda own: state(own["left"], F.concat(acc["flags"], own["flags"])),
        )

    starts = F.sequence(F.lit(1), F.size(requests), F.lit(FOLD_BLOCK))
    blocks = F.transform(starts, lambda first: F.slice(requests, first, FOLD_BLOCK))
    return F.aggregate(blocks, state(balance, F.lit("")), block)


def _folded(requests: DataFrame, credits: DataFrame, order: list[str]) -> DataFrame:
    """Settlement of credits with at most ``FOLD_LIMIT`` requests.

    Where all requests together fit the balance their order does not matter and
    the fold is skipped.
    """
    rest = [c for c in requests.columns if c not in (*order, "credito_id")]
    listed = requests.groupBy("credito_id").agg(
        F.array_sort(F.collect_list(F.struct(*order, *rest))).alias("reqs"),
        F.sum("q").alias("asked"),
        F.min("q").alias("least"),
        F.count("q").alias("valid"),
    )
    opening = credits.select(F.col("id").alias("credito_id"), F.col("saldo_kwh").cast(BALANCE).alias("saldo"))
    all_fit = (
        (F.col("least") >= 0) & (F.col("valid") == F.size("reqs")) & (F.col("asked") <= F.col("saldo"))
    )
    every = F.array_repeat(F.lit("1"), F.size("reqs"))
    flags = F.split(_fold(F.col("reqs"), F.col("saldo"))["flags"], "")
    return (
        listed.join(opening, "credito_id", "left")
        .withColumn("flags", F.when(all_fit, every).otherwise(flags))
        .select("credito_id", "saldo", F.explode(F.arrays_zip("reqs", "flags")).alias("x"))
        .select("credito_id", "saldo", "x.reqs.*", (F.col("x.flags") == "1").alias("aceita"))
    )


# Columns of a block beside the requests': task that sorted it, place there, requests, their sum and quantities.
CHUNK, PART, ROWS, ASKED, QUANTITIES, START = "__chunk", "__part", "__rows", "__asked", "__qs", "__start"
BLOCK_KEY = ["credito_id", CHUNK, PART]


def _stored_blocks(requests: DataFrame, rows: int, order: list[str], block_rows: int) -> DataFrame:
    """Requests in the order of their credit, in blocks of ``block_rows`` or less (eager).

    A column of a block is the list of its requests' values.
    """
    cores = requests.sparkSession.sparkContext.defaultParallelism
    width = max(cores, math.ceil(rows / CHUNK_ROWS))
    placed = (
        requests.repartitionByRange(width, "credito_id", *order)
        .sortWithinPartitions("credito_id", *order)
        .withColumns({CHUNK: F.spark_partition_id(), QUANTITIES: F.col("quantidade_kwh").try_cast(QUANTITY)})
    )
    listed = [f for f in placed.schema if f.name not in ("credito_id", CHUNK)]
    fields = [StructField(f.name, ArrayType(f.dataType)) for f in listed]
    key = StructType().add("credito_id", "long").add(CHUNK, "integer").add(PART, "integer").add(ROWS, "integer").add(ASKED, BALANCE)
    blocks = placed.mapInArrow(partial(_blocked, listed=[f.name for f in listed], block_rows=block_rows), StructType([*key, *fields]))
    return materialise(blocks, "settlement-blocks", **STORED_BLOCKS)


def _blocked(batches: Iterator[pa.RecordBatch], listed: list[str], block_rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted requests as blocks, each of one credit."""
    held: list[pa.RecordBatch] = []
    credit, rows, part = None, 0, 0

    def block() -> pa.RecordBatch:
        columns = {name: pa.concat_arrays([b.column(name) for b in held]) for name in listed}
        valid = [q for q in _unscaled(columns[QUANTITIES]) if q is not None]
        ends = pa.array([0, rows], pa.int32())
        arrays = [
            pa.array([credit], pa.int64()),
            held[0].column(CHUNK).slice(0, 1),
            pa.array([part], pa.int32()),
            pa.array([rows], pa.int32()),
            _money([sum(valid) if valid else None]),
            *[pa.ListArray.from_arrays(ends, values) for values in columns.values()],
        ]
        return pa.RecordBatch.from_arrays(arrays, names=[*BLOCK_KEY, ROWS, ASKED, *columns])

    for batch in batches:
        credits = batch.column("credito_id").to_numpy()
        bounds = [0, *(np.flatnonzero(credits[1:] != credits[:-1]) + 1).tolist(), len(credits)] if len(credits) else []
        for begin, end in zip(bounds, bounds[1:]):
            if held and credits[begin] != credit:
                yield block()
                held, rows, part = [], 0, part + 1
            credit = int(credits[begin])
            while begin < end:
                taken = min(end - begin, block_rows - rows)
                held.append(batch.slice(begin, taken))
                begin, rows = begin + taken, rows + taken
                if rows == block_rows:
                    yield block()
                    held, rows, part = [], 0, part + 1
    if held:
        yield block()


def _in_slices(blocks: DataFrame, sizes: DataFrame, slice_rows: int, block_rows: int) -> DataFrame:
    """Where each block lies: its slice, the place ``at`` in it and what its requests ask for (eager)."""
    width = F.greatest(F.lit(slice_rows), F.ceil(F.col("n") / MOST_SLICES))
    # Slices begin with a block.
    widths = sizes.select("credito_id", (F.ceil(width / block_rows) * block_rows).alias("width"))
    earlier = Window.partitionBy("credito_id").orderBy(CHUNK, PART).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(ROWS).over(earlier), F.lit(0))
    inside = Window.partitionBy("credito_id", "slice").orderBy(CHUNK, PART)
    return materialise(
        blocks.select(*BLOCK_KEY, ROWS, F.col(ASKED).alias("asked"))
        .withColumn("before", before)
        .join(widths, "credito_id")
        .withColumn("slice", F.expr("before div width"))
        .select(*BLOCK_KEY, "slice", "asked", (F.row_number().over(inside) - 1).alias("at")),
        "settlement-slices",
    )


FOLDED = "credito_id bigint, slice bigint, start decimal(38,6), net decimal(38,6), low decimal(38,6), high decimal(38,6), taken array<decimal(38,6)>"
STARTS = "credito_id bigint, slice bigint, start decimal(38,6), again boolean"
MONEY = pa.decimal128(38, 6)


def _unscaled(values: pa.Array) -> list[int | None]:
    """Decimals as whole millionths."""
    pairs = np.frombuffer(values.buffers()[1], dtype="<i8")[2 * values.offset :][: 2 * len(values)].reshape(-1, 2)
    low, high = pairs[:, 0], pairs[:, 1]
    if (high == low >> 63).all():
        whole = low.tolist()
    else:
        whole = [(h << 64) | (x & 0xFFFFFFFFFFFFFFFF) for x, h in zip(low.tolist(), high.tolist())]
    if values.null_count:
        return [v if there else None for v, there in zip(whole, values.is_valid().to_pylist())]
    return whole


def _money(values: list[int | None]) -> pa.Array:
    def exact(v: int) -> Decimal:
        return Decimal((int(v < 0), tuple(map(int, str(abs(v)))), -6))

    return pa.array([None if v is None else exact(v) for v in values], MONEY)


class _Slice:
    """A fold under way: the balance, and how far the start could move either way."""

    def __init__(self, start: int):
        self.start = self.left = start
        self.down: int | None = None
        self.up: int | None = None

    def take(self, quantities: list[int | None]) -> list[bool]:
        """Outcomes of the next requests."""
        left, down, up = self.left, self.down, self.up
        flags = []
        for q in quantities:
            fits = q is not None and left >= q
            flags.append(fits)
            if fits:
                left -= q
                if down is None or left < down:
                    down = left
            elif q is not None and (up is None or q - left < up):
                up = q - left
        self.left, self.down, self.up = left, down, up
        return flags

    def bounds(self) -> tuple[int, int, int | None, int | None]:
        """Start, net amount taken, and the starts from ``low`` to below ``high`` of equal outcomes."""
        low = None if self.down is None else self.start - self.down
        high = None if self.up is None else self.start + self.up
        return self.start, self.start - self.left, low, high


def _fold_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Net amount and interval of each slice, from its sorted blocks, and the net amounts taken before each block."""
    key, run, taken, done = None, None, [], []

    def batch_of(done: list) -> pa.RecordBatch:
        credit, number, start, net, low, high, taken = zip(*done)
        ends = pa.array(np.cumsum([0, *map(len, taken)]), pa.int32())
        lists = pa.ListArray.from_arrays(ends, _money([x for each in taken for x in each]))
        arrays = [pa.array(credit, pa.int64()), pa.array(number, pa.int64()), *map(_money, (start, net, low, high)), lists]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in FOLDED.split(", ")])

    for batch in batches:
        starts = _unscaled(batch.column("start"))
        for k in range(batch.num_rows):
            at = tuple(batch.column(c)[k].as_py() for c in ("credito_id", "slice"))
            if at != key:
                if run:
                    done.append((*key, *run.bounds(), taken))
                key, run, taken = at, _Slice(starts[k]), []
            taken.append(run.start - run.left)
            run.take(_unscaled(batch.column(QUANTITIES).slice(k, 1).flatten()))
    if run:
        done.append((*key, *run.bounds(), taken))
        yield batch_of(done)


def _outcomes(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The requests of each block, which starts from its true balance, with their outcomes."""
    for batch in batches:
        starts = _unscaled(batch.column(START))
        for k in range(batch.num_rows):
            block = batch.slice(k, 1)
            flags = _Slice(starts[k]).take(_unscaled(block.column(QUANTITIES).flatten()))
            credit = pa.array(np.full(len(flags), block.column("credito_id")[0].as_py(), dtype=np.int64))
            arrays = [credit if name == "credito_id" else block.column(name).flatten() for name in names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(flags, pa.bool_())], names=[*names, "aceita"])


def _chain(folds: pd.DataFrame) -> pd.DataFrame:
    """Where each slice of one credit starts, and whether its fold does not hold there."""
    folds = folds.sort_values("slice")
    out, x = [], None
    with localcontext() as exact:
        exact.prec = 80
        for f in folds.itertuples(index=False):
            x = f.start if x is None else x
            holds = (pd.isna(f.low) or x >= f.low) and (pd.isna(f.high) or x < f.high)
            out.append((f.credito_id, f.slice, x, not holds))
            x = (x if holds else f.start) - f.net
    return pd.DataFrame(out, columns=["credito_id", "slice", "start", "again"])


def _fold_slices(blocks: DataFrame, starts: DataFrame, fold, schema: str) -> DataFrame:
    """``fold`` over the blocks of the slices that ``starts`` names, each slice in one task and in order."""
    return (
        blocks.join(starts.select("credito_id", "slice", "start"), ["credito_id", "slice"])
        .repartition("credito_id", "slice")
        .sortWithinPartitions("credito_id", "slice", "at")
        .select("credito_id", "slice", "start", QUANTITIES)
        .mapInArrow(fold, schema)
    )


def _guesses(places: DataFrame, opening: DataFrame) -> DataFrame:
    """The balance each slice would start with if all before it were accepted, but no less than nothing."""
    before = Window.partitionBy("credito_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    asked = F.coalesce(F.sum("asked").over(before), F.lit(0)).cast(BALANCE)
    guess = F.when(F.col("slice") == 0, F.col("saldo")).otherwise(F.greatest(F.col("saldo") - asked, F.lit(0)))
    return (
        places.groupBy("credito_id", "slice")
        .agg(F.sum("asked").alias("asked"))
        .join(opening, "credito_id")
        .select("credito_id", "slice", guess.cast(BALANCE).alias("start"))
    )


def _in_passes(
    requests: DataFrame,
    credits: DataFrame,
    sizes: DataFrame,
    rows: int,
    order: list[str],
    slice_rows: int,
    block_rows: int,
) -> DataFrame:
    """Settlement of credits with many requests, slice by slice (eager)."""
    opening = credits.select(F.col("id").alias("credito_id"), F.col("saldo_kwh").cast(BALANCE).alias("saldo"))
    blocks = _stored_blocks(requests, rows, order, block_rows)
    places = _in_slices(blocks, sizes, slice_rows, block_rows)
    few = places.count() <= MOST_TOLD

    def told(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if few else table

    quantities = blocks.select(*BLOCK_KEY, QUANTITIES).join(told(places.drop("asked")), BLOCK_KEY)
    guesses = materialise(_guesses(places, opening), "settlement-guesses")
    folds = materialise(_fold_slices(quantities, told(guesses), _fold_bounds, FOLDED), "settlement-folds")
    while True:
        starts = materialise(
            folds.drop("taken").groupBy("credito_id").applyInPandas(_chain, STARTS), "settlement-starts"
        )
        again = starts.filter("again")
        if again.isEmpty():
            break
        held = folds.join(again.select("credito_id", "slice"), ["credito_id", "slice"], "left_anti")
        folds = materialise(
            held.unionByName(_fold_slices(quantities, told(again), _fold_bounds, FOLDED)), "settlement-folds"
        )
    taken = folds.select("credito_id", "slice", F.posexplode("taken").alias("at", "taken"))
    balances = materialise(
        places.join(taken, ["credito_id", "slice", "at"])
        .join(starts.select("credito_id", "slice", "start"), ["credito_id", "slice"])
        .select(*BLOCK_KEY, (F.col("start") - F.col("taken")).cast(BALANCE).alias(START)),
        "settlement-balances",
    )
    schema = StructType([*requests.schema, StructField("aceita", BooleanType())])
    decided = blocks.join(told(balances), BLOCK_KEY).mapInArrow(partial(_outcomes, names=requests.columns), schema)
    # Whatever is left, these credits are known.
    return _prepared(decided).withColumn("saldo", F.lit(0).cast(BALANCE))


def settle(
    credits: DataFrame,
    requests: DataFrame,
    order: list[str] = ORDER,
    fold_limit: int = FOLD_LIMIT,
    slice_rows: int = SLICE_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every sale request with its outcome.

    ``order`` must put the requests of a credit in one definite order. Counts
    the requests per credit first (eager) to choose the way; a sale of an
    expired credit or of a non-positive quantity goes through but is flagged.
    """
    # A credit without a balance is as good as none.
    known = credits.filter(F.col("saldo_kwh").isNotNull()).select(F.col("id").alias("credito_id"))
    counts = requests.groupBy("credito_id").agg(F.count("*").alias("n")).filter(F.col("n") > fold_limit)
    many = materialise(counts.join(known, "credito_id", "left_semi"), "settlement-ids")
    size = many.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # Requests of credits with many are taken out first, so that only the others meet all credits.
    rest = _prepared(requests if size[0] == 0 else requests.join(many, "credito_id", "left_anti"))
    # Requests of no known credit are refused whatever the order: they join no fold or pass.
    refused = rest.join(known, "credito_id", "left_anti").withColumns(
        {"saldo": F.lit(None).cast(BALANCE), "aceita": F.lit(False)}
    )
    decided = _folded(rest.join(known, "credito_id", "left_semi"), credits, order)
    if size[0]:
        mine = requests.join(many, "credito_id", "left_semi")
        decided = decided.unionByName(_in_passes(mine, credits, many, size[1], order, slice_rows, block_rows))
    decided = decided.unionByName(refused, allowMissingColumns=True)
    reason = (
        F.when(F.col("aceita"), SOLD)
        .when(F.col("q").isNull(), INVALID)
        .when(F.col("saldo").isNull(), UNKNOWN_CREDIT)
        .otherwise(TOO_LITTLE)
    )
    return (
        decided.withColumn("status", reason)
        .withColumn("sinal_suspeito", F.when(F.col("quantidade_kwh") <= 0, 1).otherwise(0))
        .withColumn("tipo", F.lit(KIND))
        .drop("q", "saldo", "aceita")
    )


def sold(settled: DataFrame) -> DataFrame:
    """Accepted sales: the rows a transaction table keeps."""
    return settled.filter(F.col("status") == SOLD)


def rejected(settled: DataFrame) -> DataFrame:
    """Refused sales with their reason in ``status``."""
    return settled.filter(F.col("status") != SOLD)


def balances(credits: DataFrame, settled: DataFrame) -> DataFrame:
    """The credit table after the accepted sales."""
    taken = (
        sold(settled)
        .groupBy(F.col("credito_id").alias("id"))
        .agg(F.sum(F.col("quantidade_kwh").cast(QUANTITY)).alias("taken"))
    )
    after = F.col("saldo_kwh").cast(BALANCE) - F.col("taken")
    return (
        credits.join(taken, "id", "left")
        .withColumn(
            "saldo_kwh",
            F.when(F.col("taken").isNull(), F.col("saldo_kwh")).otherwise(after.cast("double")),
        )
        .select(credits.columns)
    )
