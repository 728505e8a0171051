"""Exact token counts at every prefix of a text, for byte-level BPE."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundgrid.shipping import mapped

#: How byte-level BPE cuts a text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of a worker's table of words; it is emptied when full.
CACHE = 400_000


class PrefixCounter:
    """Counts tokens of every prefix with one pass of dynamic programming over each distinct word.

    BPE has this property: the encoding of a word's first ``i`` bytes is the encoding of its first ``j < i``
    bytes and one more token, for exactly one ``j``: that whose last token stays apart from the new one when the two are
    encoded together. So ``count[i] = count[j] + 1``. A text's counts are kept as differences from character to
    character (signed bytes); those of a text are those of its words, one after the other, but for runs of white
    space, cut-off contractions and special tokens, where a prefix is cut into words differently.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or spec.get("normalizer"):
            raise ValueError(f"{path} isn't a plain byte-level BPE")
        self.byte_of = self._byte_alphabet()
        to_bytes = lambda token: bytes(self.byte_of[c] for c in token)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {(to_bytes(a), to_bytes(b)): k for k, (a, b) in enumerate(pairs)}
        self.number = {bytes([b]): b for b in range(256)} | {a + b: 256 + k for (a, b), k in self.rank.items()}
        self.number = {t: k for t, k in self.number.items() if self.encoded(t) == [t]}
        self.token = {k: t for t, k in self.number.items()}
        self.longest = max(map(len, self.number))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.words = regex.compile(PATTERN).findall
        self.runs = regex.compile(r"\s\s").search
        self.apart: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _byte_alphabet() -> dict[str, int]:
        """The characters that stand for bytes in vocabulary files: printable ones stand for themselves, others follow from 256."""
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}

    def encoded(self, word: bytes) -> list[bytes]:
        """Plain BPE of a few bytes: merge the pair of lowest rank, leftmost first, until none is left."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 30))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def stay_apart(self, left: int, right: int) -> bool:
        key = left << 20 | right
        found = self.apart.get(key)
        if found is None:
            if len(self.apart) > 4 * CACHE:
                self.apart.clear()
            a, b = self.token[left], self.token[right]
            found = self.apart[key] = self.encoded(a + b) == [a, b]
        return found

    def counts(self, word: bytes) -> list[int]:
        """Tokens of each prefix of a word's bytes, from the empty one on."""
        count, last, number, apart = [0], [0], self.number.get, self.apart.get
        for i in range(1, len(word) + 1):
            for j in range(i - 1, max(0, i - self.longest) - 1, -1):
                t = number(word[j:i])
                if t is None:
                    continue
                if j:
                    free = apart(last[j] << 20 | t)
                    if free is None:
                        free = self.stay_apart(last[j], t)
                    if not free:
                        continue
                count.append(count[j] + 1)
                last.append(t)
                break
        return count

    def word(self, word: str) -> bytes:
        """Differences between the token counts at a word's characters."""
        if (found := self.known.get(word)) is None:
            data = word.encode()
            at = self.counts(data)
            if len(data) != len(word):
                at = [c for i, c in enumerate(at) if not i or i == len(data) or data[i] & 0xC0 != 0x80]
            if word in ("'ll", "'re", "'ve"):  # cut after one letter, it is an apostrophe and a letter
                at[2] = 2
            if len(word) > 100 and any(abs(b - a) > 127 for a, b in pairwise(at)):
                raise ValueError("a token count changes by over 127 from one character to the next")
            found = bytes([b - a & 255 for a, b in pairwise(at)])
            if len(self.known) >= CACHE:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = found
        return found

    def plain(self, text: str) -> bytes:
        """Differences for a text without special tokens."""
        words = self.words(text)
        known = self.known.get
        parts = [known(w) or self.word(w) for w in words]
        if not self.runs(text):
            return b"".join(parts)
        out = np.frombuffer(b"".join(parts), np.int8).copy()
        at = 0
        for k, w in enumerate(words[:-1]):
            at += len(w)
            after = words[k + 1]
            # Up to the first character of what follows a run of white space, the whole run is one word.
            if w[-1].isspace() and after[0].isspace() and w.isspace():
                more = int(np.frombuffer(self.word(w + after[0]), np.int8)[-1]) - int(out[at])
                out[at] += more
                if at + 1 < len(out):
                    out[at + 1] -= more
        return out.tobytes()

    def text(self, text: str) -> bytes:
        if not self.split or not any(s in text for s in self.special):
            return self.plain(text)
        out, done, at = [], 0, 0
        for found in self.split.finditer(text):
            before = text[at : found.start()]
            out.append(self.plain(before))
            base = int(np.frombuffer(out[-1], np.int8).sum(dtype=np.int64))
            counts = [base, *(int(np.frombuffer(self.plain(before + found[0][:k]), np.int8).sum(dtype=np.int64)) for k in range(1, len(found[0]))), base + 1]
            out.append(np.diff(counts).astype(np.int8).tobytes())
            at = found.end()
        return b"".join([*out, self.plain(text[at:])])


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Token counts at every prefix of every text of ``docs``.

    Returns the input's columns but the text, ``token_steps`` (a signed byte for each character: how the count
    changes with it) and ``n_tokens`` (their sum, the text's own count). Input columns of these names are
    replaced. A null or empty text has no steps and 0 tokens; texts of any length are read whole; special tokens in a text
    count one each, as the tokenizer's library has it. ``path`` names the vocabulary file on every machine.
    Repeated rows are counted each, an empty table gives no rows. A character at which the count changes by over 127, which no known vocabulary has, is an error.
    Without a shuffle: one pass in which each worker keeps a bounded table of words.
    """
    kept = [c for c in docs.columns if c not in (text, "token_steps", "n_tokens")]
    read = docs.select(*kept, F.col(text).alias("token_steps"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counter(path)
        for batch in batches:
            at = batch.schema.get_field_index("token_steps")
            steps = [table.text(t) if t else b"" for t in batch.column(at).to_pylist()]
            n = [int(np.frombuffer(s, np.int8).sum(dtype=np.int64)) for s in steps]
            columns = [*batch.columns[:at], pa.array(steps, pa.binary()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "n_tokens"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema), "token_steps binary", "n_tokens long"])
    return mapped(read, count, schema)


def tokens_at(steps: str | Column, characters: str | Column) -> Column:
    """Tokens of the prefix of so many characters; of the whole text, if it is shorter. Null if either is null."""

    @F.pandas_udf("long")
    def at(s, n):
        return (s.combine(n, lambda b, k: None if b is None or k != k else int(np.frombuffer(b, np.int8)[: max(int(k), 0)].sum(dtype=np.int64)))).astype("Int64")

    return at(steps, characters)


def longest_within(steps: str | Column, budget: str | Column) -> Column:
    """Characters of the longest prefix that has at most ``budget`` tokens. Null if either is null."""

    @F.pandas_udf("long")
    def longest(s, n):
        def one(b, k):
            if b is None or k != k:
                return None
            fits = np.flatnonzero(np.cumsum(np.frombuffer(b, np.int8), dtype=np.int64) <= k)
            return int(fits[-1]) + 1 if len(fits) else 0

        return s.combine(n, one).astype("Int64")

    return longest(steps, budget)
