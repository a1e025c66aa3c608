"""Small inputs with the awkward rows that every operator must take."""

import public_tokenizers
from tokenizers import Tokenizer

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, hash string"
LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
ROWS = [
    (1, "The same text here, and nothing else.", "en", "a"),
    (2, "The same\t\ttext here, and\nnothing else.", "en", "a"),
    (3, "the same text here, and nothing else.", "en", "b"),
    (4, None, None, None),
    (5, "", "en", "b"),
    (6, " \n ", "de", "c"),
    (7, "Ünïcode \U0001f600 ßtraße İ é   <|endoftext|> it's 123", "de", "c"),
    (8, LONG, "en", "c"),
    (8, LONG, "en", "c"),
    (9, LONG[:100_000], "en", None),
    (None, "a row without an id", "en", "a"),
    (None, "The same text here, and nothing else.", "en", "a"),
    (12, "tie one two three four five six", "en", "d"),
    (11, "tie one two three four five six", "en", "d"),
]


def documents(spark, rows=ROWS):
    """The rows with clashing extra columns ``size`` and ``hash``."""
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", "y") for r in rows], DOCUMENTS).repartition(3)


def tokenizer():
    return public_tokenizers.path("word_bpe_49k.json")


def encode(texts, end_id):
    """The ids of each text by the library itself, with the end id."""
    plain = Tokenizer.from_file(tokenizer())
    return [e.ids + [end_id] for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def rows(df):
    return [tuple(r) for r in df.collect()]
