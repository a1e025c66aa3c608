"""Text to number and JSON helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER = r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?"
LARGEST_DOUBLE = 1.7976931348623157e308


def decimal_comma(text: Column) -> Column:
    """``12,5`` to ``12.5``; thousands dots are left alone."""
    return F.replace(text, F.lit(","), F.lit("."))


def leading_number(text: Column) -> Column:
    """The number a text starts with, 0.0 when it starts with none.

    The lenient reading a weakly typed column gives: ``1.200.50`` is 1.2 and
    ``abc`` is 0.0. NULL stays NULL. Clean numbers skip the pattern.
    """
    whole = text.try_cast("double")
    finite = F.when(F.abs(whole) <= LARGEST_DOUBLE, whole)
    head = F.regexp_extract(text, rf"^\s*({NUMBER})", 1).try_cast("double")
    return F.coalesce(finite, head, F.when(text.isNotNull(), 0.0))


def parse_power(text: Column) -> Column:
    """Number written the Brazilian (``1.200,50``) or plain (``1200.50``) way.

    A comma marks the Brazilian form, whose dots separate thousands. Blank or
    malformed text gives NULL.
    """
    plain = F.when(
        text.contains(","), decimal_comma(F.replace(text, F.lit("."), F.lit("")))
    ).otherwise(text)
    return F.when(plain.rlike(rf"^\s*{NUMBER}\s*$"), F.trim(plain).try_cast("double"))


def first_truthy(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor zero; the last one as it is."""
    *front, last = candidates
    return F.coalesce(*[F.nullif(c, F.lit(0.0)) for c in front], last)


def first_filled(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])


def json_columns(text: str, schema: str) -> Column:
    """The fields of a JSON text as columns of a ``select``.

    As a generator it is evaluated once per row: a later filter on one of the
    fields does not drag a second parse below it.
    """
    return F.inline(F.array(F.from_json(text, schema)))


def row_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """SHA-256 over the row as JSON with its keys in alphabetical order.

    Independent of the column order; NULL fields take part.
    """
    names = sorted(columns or df.columns)
    body = F.to_json(F.struct(*[F.col(f"`{n}`") for n in names]), {"ignoreNullFields": "false"})
    return F.sha2(body, 256)


def packed_hash(text: Column) -> Column:
    """A row hash as its 32 bytes, to shuffle half as much; any other text as itself and a tail.

    With its tail of 33 blanks another text is longer than 32 bytes, so different texts stay different.
    """
    hexadecimal = (F.octet_length(text) == 64) & (F.lower(text) == text)
    return F.coalesce(F.when(hexadecimal, F.unhex(text)), F.encode(F.concat(text, F.lit(" " * 33)), "utf-8"))


def unpacked_hash(packed: Column) -> Column:
    """The text that ``packed_hash`` was made from."""
    text = F.decode(packed, "utf-8")
    return F.when(F.octet_length(packed) == 32, F.lower(F.hex(packed))).otherwise(text.substr(F.lit(1), F.length(text) - 33))
