"""Chat formatting with budgeted windows.

The turns of a conversation get token prefix sums. A turn belongs to the span of
``span_budget`` tokens in which it starts, so spans are turn-aligned and are found
without walking through the conversation. A window holds the system turn, then
history, then the span's own turns. History has no holes: it is the turn just
before the span, however long, and those before it as far as they start within
``history_budget`` tokens of the span. Only a span's own assistant turns are under
the loss mask; what a window repeats is masked out.

A window has at most system + history_budget + span_budget tokens, the turn before
the span and the rest of its last turn, as turns are never cut. Prefix sums are taken in blocks of turn
numbers and over the blocks' totals, so a conversation of any length spreads over
many tasks; a window is the largest group that is gathered.

Template: ``<|turn|>role\\ntext<|end|>\\n``. Control strings inside texts and roles
get one more backslash after their first character, so none is left as it was and
removing one backslash restores the text.

Defined results: null roles and texts are empty; null conversation ids form one
conversation; null turn numbers come first; turns with equal numbers are ordered
by role and text, and repeated rows stay repeated; a leading turn of role
``system`` is the system turn; an empty table gives no windows. Texts of any length
stay whole; columns of any other name are never looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm.tokens import encoder, runs
from gridspark.session import materialise

SPAN_BUDGET = 1024
HISTORY_BUDGET = 256
# Turn numbers of one block of a prefix sum.
BLOCK_TURNS = 256
# Tokens of the template around a turn.
TEMPLATE_TOKENS = 4
TURNS = "conv bigint, turn bigint, role string, text string, tokens bigint"
TURN, END = "<|turn|>", "<|end|>"
# Control strings of chat templates in use, escaped besides our own.
CONTROL = r"(/?s>|/?INST\]|\|turn\|>|\|end\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|</?SYS>>|/?SYS>>)"
ESCAPE = r"([<\[])(\\*)" + CONTROL
UNESCAPE = re.compile(r"([<\[])\\(\\*)" + CONTROL)
BATCH_ROWS = 2_000


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescaped(text: str) -> str:
    return UNESCAPE.sub(r"\1\2\3", text)


def escaped_role(role: Column) -> Column:
    """As text, on one line: backslash and line break are written as two characters."""
    one_line = F.regexp_replace(F.regexp_replace(role, r"\\", r"\\\\"), "\n", r"\\n")
    return escaped(one_line)


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role), flags=re.S)


def tokens(text: Column) -> Column:
    """Estimated tokens of a turn without a tokenizer: words, marks and signs of scripts without blanks."""
    one = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]"
    return F.regexp_count(text, F.lit(rf"{one}|(?:(?!{one})[\p{{L}}\p{{N}}])+|[^\s\p{{L}}\p{{N}}]"))


def with_tokens(turns: DataFrame, tokenizer: str | None) -> DataFrame:
    """``turns`` (conv, turn, role, text) with the tokens of each by a tokenizer file, and those of the template."""
    if tokenizer is None:
        return turns.withColumn("tokens", (tokens(F.col("text")) + TEMPLATE_TOKENS).cast("bigint"))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            counts = [np.zeros(0, np.int64)]
            for a, b in runs(texts):
                counts.append(encoder(tokenizer).encode(texts.slice(a, b - a))[1])
            counted = pa.array(np.concatenate(counts) + TEMPLATE_TOKENS)
            yield pa.RecordBatch.from_arrays([*batch.columns, counted], names=[*batch.schema.names, "tokens"])

    return turns.mapInArrow(part, TURNS)


def prefix_sums(turns: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``turns`` (conv, turn, role, text) with ``start``, the tokens before each, and ``place``."""
    block = F.floor(F.coalesce("turn", F.lit(-(2**62))) / BLOCK_TURNS)
    rows = with_tokens(turns, tokenizer).withColumn("block", block)
    if tokenizer is not None:
        rows = materialise(rows, "chat-tokens")  # encoded once, read twice
    totals = rows.groupBy("conv", "block").agg(
        F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("turns")
    )
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col("conv").alias("c"),
        F.col("block").alias("b"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("turns_before"),
    )
    order = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    inside = rows.withColumn(
        "start", F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("place", F.row_number().over(order) - 1)
    return (
        inside.join(starts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
        .withColumn("start", F.col("start") + F.col("tokens_before"))
        .withColumn("place", F.col("place") + F.col("turns_before"))
        .select("conv", "turn", "role", "text", "tokens", "start", "place")
    )


def windows(
    conversations: DataFrame,
    span_budget: int = SPAN_BUDGET,
    history_budget: int = HISTORY_BUDGET,
    tokenizer: str | None = None,
) -> DataFrame:
    """Formatted windows of ``conversations`` (conv_id, turn, role, text).

    conv_id, span, repeated (leading turns taken over from earlier), n_tokens, text
    and loss, an array of [start, end) code point ranges of the text. Budgets count
    tokens of the ``tokenizer`` file, or estimated ones without it.
    """
    if not 0 <= history_budget < span_budget:
        raise ValueError("history must be shorter than a span")
    turns = conversations.select(
        F.col("conv_id").alias("conv"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    placed = materialise(
        prefix_sums(turns, tokenizer).withColumn("span", F.floor(F.col("start") / span_budget)), "chat-turns"
    )
    # A turn has a token at least, so a span is a small group. The next one begins where it ends.
    behind = F.max(F.col("start") + F.col("tokens")).over(Window.partitionBy("conv", "span"))
    system = (F.col("place") == 0) & (F.col("role") == "system")
    last = F.col("start") + F.col("tokens") == F.col("behind")
    following = F.floor(F.col("behind") / span_budget)
    near = (F.col("behind") - F.col("start") <= history_budget) | last
    recent = near & ~system & (following > F.col("span"))
    piece = F.struct(
        "place",
        F.concat(F.lit(TURN), escaped_role(F.col("role")), F.lit("\n")).alias("head"),
        escaped(F.col("text")).alias("body"),
        F.col("role").alias("role"),
        F.col("tokens").alias("tokens"),
        F.col("own").alias("own"),
    )
    uses = F.array(F.struct(F.col("span").alias("in_span"), F.lit(True).alias("own")))
    again = F.when(
        recent, F.array(F.struct(following.alias("in_span"), F.lit(False).alias("own")))
    ).otherwise(F.array().cast("array<struct<in_span:bigint,own:boolean>>"))
    gathered = (
        placed.withColumn("behind", behind)
        .select("*", F.inline(F.concat(uses, again)))
        .select("conv", F.col("in_span").alias("span"), piece.alias("piece"))
        .groupBy("conv", "span")
        .agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
        .filter(F.exists("pieces", lambda p: p["own"]))
    )
    systems = placed.filter(system).withColumn("own", F.lit(False)).select(
        F.col("conv").alias("system_conv"), piece.alias("system")
    )
    joined = gathered.join(systems, F.col("conv").eqNullSafe(F.col("system_conv")), "left")
    # The first span holds the system turn itself.
    full = F.when(
        F.col("system").isNotNull() & (F.col("pieces")[0]["place"] > 0),
        F.concat(F.array("system"), F.col("pieces")),
    ).otherwise(F.col("pieces"))
    # Lengths as prefix sums: where each piece's body begins in the window's text.
    closing = len(END) + 1
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("loss"))

    def step(acc, p):
        begin = acc["at"] + F.length(p["head"])
        end = begin + F.length(p["body"])
        marked = p["own"] & (p["role"] == "assistant")
        loss = F.when(
            marked, F.concat(acc["loss"], F.array(F.struct(begin.alias("start"), end.alias("end"))))
        ).otherwise(acc["loss"])
        return F.struct((end + closing).alias("at"), loss.alias("loss"))

    return joined.select("conv", "span", full.alias("pieces")).select(
        F.col("conv").alias("conv_id"),
        "span",
        F.size(F.filter("pieces", lambda p: ~p["own"])).alias("repeated"),
        F.aggregate("pieces", F.lit(0).cast("bigint"), lambda n, p: n + p["tokens"]).alias("n_tokens"),
        F.array_join(
            F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n"))), ""
        ).alias("text"),
        F.aggregate("pieces", start, step)["loss"].alias("loss"),
    )


def parse(text: str) -> Iterator[tuple[str, str]]:
    """The (role, text) turns of a window's text."""
    for turn in text.split(TURN)[1:]:
        head, _, body = turn.partition("\n")
        yield unescaped_role(head), unescaped(body[: -len(END) - 1])


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
    " formatted_chars bigint, n_windows bigint"
)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, from its windows alone.

    Windows stream through a task in order; one window and two running digests
    are held, whatever the length of a conversation.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        current = None
        for batch in batches:
            for conv, repeated, text, loss in zip(
                *(batch.column(n).to_pylist() for n in ("conv_id", "repeated", "text", "loss"))
            ):
                if current is None or current[0] != conv:
                    if current is not None:
                        rows.append(_closed(current))
                    current = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                    if len(rows) >= BATCH_ROWS:
                        yield _digest_batch(rows)
                        rows = []
                for number, (role, said) in enumerate(parse(text)):
                    if number >= repeated:
                        current[1] += 1
                        current[2].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    said = unescaped(text[span["start"] : span["end"]])
                    current[3] += len(said)
                    current[4].update(said.encode())
                current[5] += len(text)
                current[6] += 1
        if current is not None:
            rows.append(_closed(current))
        if rows:
            yield _digest_batch(rows)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "span")
    return ordered.mapInArrow(part, DIGESTS)


def _closed(state: list) -> tuple:
    conv, turns, digest, chars, loss, formatted, n = state
    return conv, turns, digest.hexdigest(), chars, loss.hexdigest(), formatted, n


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows")
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
