"""Benchmark passages in texts, found by spaced seeds and verified with substitutions allowed."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from soundgrid.llm.common import WORD
from soundgrid.llm.words import mix, row_groups, text_bytes, word_hashes
from soundgrid.shipping import mapped

#: Fixed masks over word positions: 1 is compared, 0 is ignored. Together they hit every stretch that counts with the default
#: ``similarity`` and ``least``, for items of any length from ``SHORT`` words, wherever its other words are (tested).
MASKS = ("111111", "11101011", "110110011", "11010111", "1110001011", "1111011")
#: Items of fewer words have one seed, all of their words.
SHORT = 8
_FACTORS = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(7919)) | np.uint64(1)
_FILTER = 1 << 22


def seeds(hashes: np.ndarray, pattern: str) -> np.ndarray:
    """The mask's hash at each position where it fits."""
    n = max(len(hashes) - len(pattern) + 1, 0)
    out = np.full(n, np.uint64(int("1" + pattern, 2)), np.uint64)
    for j, bit in enumerate(pattern):
        if bit == "1":
            out += hashes[j : j + n] * _FACTORS[j]
    return mix(out)


@dataclass
class SeedTable:
    """The seeds of a block of benchmark items, sorted by hash, and a filter over the hashes' low bits.

    ``at`` is a seed's first word among all words of the block. ``masks`` are those of the items: short ones have their own.
    """

    ids: pa.Array
    words: np.ndarray
    firsts: np.ndarray
    masks: tuple[str, ...]
    hashes: np.ndarray
    at: np.ndarray
    seen: np.ndarray

    @classmethod
    def of(cls, ids: pa.Array, texts: list[str]) -> SeedTable:
        words, _, _, firsts = word_hashes(*text_bytes(pa.array(texts, pa.string())))
        found, at, masks = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], set()
        for a, b in zip(firsts[:-1], firsts[1:]):
            for m in MASKS if b - a >= SHORT else ("1" * (b - a),) if b > a else ():
                s = seeds(words[a:b], m)
                found.append(s)
                at.append(np.arange(a, a + len(s), dtype=np.int32))
                masks.add(m)
        hashes, at = np.concatenate(found), np.concatenate(at)
        order = np.argsort(hashes, kind="stable")
        seen = np.zeros(_FILTER, bool)
        seen[(hashes & np.uint64(_FILTER - 1)).astype(np.int64)] = True
        return cls(ids, words, firsts, tuple(sorted(masks)), hashes[order], at[order], seen)

    def hits(self, words: np.ndarray) -> np.ndarray:
        """``item, shift`` of each alignment of a text's words with an item that some seed hits."""
        found = [np.zeros((0, 2), np.int64)]
        for m in self.masks:
            s = seeds(words, m)
            here = np.flatnonzero(self.seen[(s & np.uint64(_FILTER - 1)).astype(np.int64)])
            low, high = np.searchsorted(self.hashes, s[here], "left"), np.searchsorted(self.hashes, s[here], "right")
            n = high - low
            entry = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = self.at[entry].astype(np.int64)
            item = np.searchsorted(self.firsts, at, "right") - 1
            found.append(np.column_stack([item, np.repeat(here, n) - at + self.firsts[item]]))
        return np.unique(np.concatenate(found), axis=0)

    @property
    def needed(self) -> np.ndarray:
        """The least number of equal words of each item, but for the caller's own bound: four fifths, all of a short item, or never."""
        n = np.diff(self.firsts)
        return np.where(n >= SHORT, np.ceil(0.8 * n), np.where(n > 0, n, np.inf))

    def overlap(self, words: np.ndarray, item: int, shift: int, similarity: float) -> tuple[int, int, int]:
        """Best stretch of one alignment: first word in the text, words, and how many are the same.

        The best stretch has the most equal words of all whose share of equal words is ``similarity`` at least, and of those
        the fewest words. Sums of ``1 - similarity`` for each equal word less ``similarity`` for each other one tell the share:
        from each start, the furthest end whose sum isn't below the start's has the most equal words.
        """
        own = self.words[self.firsts[item] : self.firsts[item + 1]]
        a, b = max(shift, 0), min(shift + len(own), len(words))
        same = words[a:b] == own[a - shift : b - shift]
        starts = np.flatnonzero(same)
        if not len(starts):
            return a, 0, 0
        total = np.concatenate([[0.0], np.cumsum(np.where(same, 1 - similarity + 1e-9, -similarity))])
        highest = np.maximum.accumulate(total[::-1])  # over the ends from the last
        ends = len(total) - 1 - np.searchsorted(highest, total[starts])
        upto = np.searchsorted(starts, ends)  # equal words before each end
        n_same = upto - np.arange(len(starts))
        n_words = starts[upto - 1] + 1 - starts
        k = np.lexsort((n_words, -n_same))[0]
        return a + int(starts[k]), int(n_words[k]), int(n_same[k])


def _tables(docs: DataFrame, benchmark: DataFrame, block_words: int) -> Iterator:
    """Broadcast seed tables of the benchmark's blocks, each of about ``block_words`` words."""
    items = benchmark.select("item_id", "text").filter(F.col("text").isNotNull()).distinct().withColumn("n", F.regexp_count("text", F.lit(WORD))).filter("n > 0")
    blocks = int(-(-(items.agg(F.sum("n")).first()[0] or 0) // block_words))
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).select("item_id", "text").orderBy("item_id", "text").toArrow().combine_chunks()
        ids = rows.column("item_id").combine_chunks() if len(rows) else pa.array([], rows.schema.field("item_id").type)
        yield docs.sparkSession.sparkContext.broadcast(SeedTable.of(ids, rows.column("text").to_pylist()))


def _overlaps(table: SeedTable, column: pa.Array, similarity: float, least: int) -> Iterator[tuple[int, int, tuple[int, int, int]]]:
    """``text, item, (first word, words, equal words)`` of each overlapping pair, by place in the column."""
    needed = table.needed
    needed = np.where(np.isinf(needed), needed, np.minimum(least, needed))
    done = 0
    for part in row_groups(column):
        hashes, _, _, firsts = word_hashes(*text_bytes(part))
        for i, (a, b) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist())):
            best: dict[int, tuple] = {}
            for item, shift in table.hits(hashes[a:b]).tolist():
                found = table.overlap(hashes[a:b], item, shift, similarity)
                if found[2] >= needed[item] and found[2] > best.get(item, (0, 0, 0))[2]:
                    best[item] = found
            for item, found in best.items():
                yield done + i, item, found
        done += len(part)


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, least: int = 12, block_words: int = 1 << 20) -> DataFrame:
    """Passages of ``benchmark(item_id, text)`` in the texts of ``docs(doc_id, text)``.

    Words are lowered in A-Z and parted by ASCII white space. An item and a text overlap if on some alignment a stretch
    has at least ``least`` equal words (four fifths of the item's words, if it has fewer than 15) and equal words make up
    ``similarity`` of the stretch, so words may be substituted. An item of fewer than ``SHORT`` words says too little for that and
    overlaps where all its words stand in sequence, one of no words nowhere. Alignments are those that a seed of one of ``MASKS`` hits: the words at the mask's 1s are the same on both sides.
    With the defaults these are all that count; with a lower ``similarity`` or ``least`` some may not be hit.

    Returns ``doc_id, item_id, first_word, n_words, n_same``: the best overlap of each pair, for each row (so repeated
    rows repeat theirs). Repeated rows of the benchmark are one item, an id with several texts is an item for each; ids may be of any type, and null. Null and empty texts and empty tables have none, other columns
    aren't read, texts are read whole. The benchmark is met in blocks of about ``block_words`` words: a block's seeds
    are a broadcast of bounded size, and a longer benchmark takes several passes. Texts are not shuffled.
    """
    kinds = [t.schema[c].dataType for t, c in ((docs, "doc_id"), (benchmark, "item_id"))]
    schema = StructType([StructField("doc_id", kinds[0]), StructField("item_id", kinds[1]), *(StructField(c, IntegerType()) for c in ("first_word", "n_words", "n_same"))])
    out = docs.sparkSession.createDataFrame([], schema)
    for table in _tables(docs, benchmark, block_words):

        def run(batches: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            known = table.value
            for batch in batches:
                found = list(_overlaps(known, batch.column(1), similarity, least))
                rows, items = (pa.array([f[k] for f in found], pa.int64()) for k in (0, 1))
                columns = [pa.array([f[2][k] for f in found], pa.int32()) for k in range(3)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), known.ids.take(items), *columns], ["doc_id", "item_id", "first_word", "n_words", "n_same"])

        out = out.unionByName(mapped(docs.select("doc_id", "text"), run, schema))
    return out


def without_overlaps(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, least: int = 12, block_words: int = 1 << 20) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has no overlap with the benchmark (see ``benchmark_overlaps``). No shuffle."""
    at = docs.columns.index("text")
    for table in _tables(docs, benchmark, block_words):

        def run(batches: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(len(batch), bool)
                clean[[f[0] for f in _overlaps(table.value, batch.column(at), similarity, least)]] = False
                yield batch.filter(pa.array(clean))

        docs = mapped(docs, run, docs.schema)
    return docs
