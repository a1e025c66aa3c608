"""Token ids of texts, by a tokenizer file of the ``tokenizers`` library.

A tokenizer that drops white space before anything that looks at neighbouring
characters gives a text the ids of its blank-separated words in order. Each
distinct word then goes through the library once per worker, and texts are put
together from the words' ids with array operations. A word of plain letters, with
or without marks after it, is cut where the tokenizer's pattern would cut it and
goes straight to the library's merge model. Other tokenizers encode whole texts.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words remembered by one worker (about 100 MB). Beyond that it forgets those
# that it met once only.
REMEMBERED = 500_000
# Texts are encoded in runs of about so many bytes.
RUN_BYTES = 8_000_000
# The settings under which words are independent of each other.
WORD_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Latin-1 letters need no normalising besides lower case; none of the marks is an
# apostrophe or part of a special token.
PLAIN_WORD = re.compile(r"([a-zß-öø-ÿ]*)([.,;:!?*%&$#()\"-]*)")


def runs(texts: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, or a single longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield first, last
        first = last


class WordEncoder:
    """Encodes string arrays; remembers the ids of words it has met."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.again: set[str] = set()
        config = json.loads(self.tokenizer.to_str())
        steps = [n["type"] for n in (config["normalizer"] or {}).get("normalizers", [])]
        cuts = (config["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        pattern = cuts[0].get("pattern", {}).get("Regex")
        self.by_words = steps == WORD_NORMALIZERS and pattern == WORD_PATTERN and config["post_processor"] is None
        if self.by_words:
            # How the byte-level step writes each letter and mark of a plain word.
            letters = [chr(c) for c in range(33, 256) if chr(c).islower() or PLAIN_WORD.fullmatch(chr(c))]
            cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
            self.written = str.maketrans({c: "".join(piece for piece, _ in cut(c)) for c in letters})

    def _part(self, part: str) -> bytes:
        """Ids of a run of letters or of marks."""
        found = self.known.get(part)
        if found is None:
            merged = self.tokenizer.model.tokenize(part.translate(self.written))
            found = self.known[part] = array("I", [t.id for t in merged]).tobytes()
        else:
            self.again.add(part)
        return found

    def _learn(self, words: list[str]) -> list[bytes]:
        known = self.known
        unknown = [w for w in words if w not in known]
        self.again.update(w for w in words if w in known)
        if len(known) + len(unknown) > self.remembered:
            self.known = known = {w: known[w] for w in self.again}
            self.again = set()
        odd = []
        for word in unknown:
            lower = word.lower()
            plain = PLAIN_WORD.fullmatch(lower)
            if not plain:
                odd.append(word)
                continue
            stem, marks = plain.groups()
            known[word] = (self._part(stem) if stem else b"") + (self._part(marks) if marks else b"")
        for word, found in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)):
            known[word] = array("I", found.ids).tobytes()
        found = [known[w] for w in words]
        if len(known) > self.remembered:
            self.known, self.again = {}, set()
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_words:
            found = [e.ids for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            return np.array([i for ids in found for i in ids], dtype="<u4"), lengths
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        pieces = self._learn(words.dictionary.to_pylist())
        length = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // 4
        pool = np.frombuffer(b"".join(pieces), dtype="<u4")
        begin = np.cumsum(length) - length
        which = words.indices.to_numpy(zero_copy_only=False)
        count = length[which]
        end = np.cumsum(count)
        ids = pool[np.repeat(begin[which] - (end - count), count) + np.arange(count.sum())]
        upto = np.concatenate([[0], end])
        bounds = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        per_text = np.diff(np.concatenate([[0], upto[bounds]])).astype(np.int64)
        return ids, per_text


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file."""
    return WordEncoder(path)


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    return np.insert(ids, np.cumsum(lengths), end_id).astype("<u4"), lengths + 1
