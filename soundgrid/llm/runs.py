"""Periodic runs of words: stretches that repeat one block of words over and over, and texts without the repeats."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundgrid.llm.words import SPACE, row_groups, text_bytes, word_hashes
from soundgrid.shipping import mapped

#: Prefix hashes are taken modulo two primes below 2^31, so products of residues fit in 64 bits.
_PRIMES = (np.uint64((1 << 31) - 1), np.uint64((1 << 31) - 19))
_PAIRS = 1 << 20


class PrefixHashes:
    """Polynomial hashes of all prefixes of a sequence of 64-bit symbols, so that two stretches are compared in constant time."""

    def __init__(self, symbols: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        self.parts = []
        for k, prime in enumerate(_PRIMES):
            base = np.uint64(rng.integers(1 << 20, int(prime) - 1))
            power = np.ones(1, np.uint64)
            while len(power) <= len(symbols):
                power = np.concatenate([power, power * (power[-1] * base % prime) % prime])
            sums = np.zeros(len(symbols) + 1, np.uint64)
            np.cumsum((symbols >> np.uint64(32 * k)) % prime * power[: len(symbols)] % prime, out=sums[1:])
            self.parts.append((prime, power, sums % prime))

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches of ``length`` symbols from ``a`` and from ``b > a`` on have equal hashes."""
        same = np.ones(len(a), bool)
        for prime, power, sums in self.parts:
            left = (sums[a + length] + prime - sums[a]) % prime * power[b - a] % prime
            same &= left == (sums[b + length] + prime - sums[b]) % prime
        return same

    def forward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The longest common extension of each pair to the right, ``most`` symbols at most: all pairs halve their range at once."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_] + 1) // 2
            same = self.equal(a[open_], b[open_], middle)
            low[open_] = np.where(same, middle, low[open_])
            high[open_] = np.where(same, high[open_], middle - 1)
        return low

    def backward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The longest common extension of each pair to the left, without the pair's own symbols."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_] + 1) // 2
            same = self.equal(a[open_] - middle, b[open_] - middle, middle)
            low[open_] = np.where(same, middle, low[open_])
            high[open_] = np.where(same, high[open_], middle - 1)
        return low


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ``counts[i]`` rows of each i: i, and the row's number within i."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _grid(firsts: np.ndarray, exponent: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Texts, periods and grid points in chunks of about ``_PAIRS``.

    A run of period q and ``exponent * q`` words has ``(exponent - 1) * q`` words in a row that equal the word q later, so
    one of them lies on every grid of that step. A text of n words has about n log(n) / (exponent - 1) pairs.
    """
    sizes = np.diff(firsts)
    text, period = _spread(sizes // exponent)
    period += 1
    points = -(-(sizes[text] - period) // ((exponent - 1) * period))
    ends = np.cumsum(points)
    k = 0
    while k < len(text):
        stop = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + _PAIRS, "right")))
        owner, number = _spread(points[k:stop])
        t, q = text[k:stop][owner], period[k:stop][owner]
        yield t, q, firsts[t] + number * (exponent - 1) * q
        k = stop


def find_runs(symbols: np.ndarray, firsts: np.ndarray, same, exponent: int = 4, least: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of each run of a batch of texts, in order of start and period.

    ``symbols`` are hashes of words, ``firsts`` where each text starts, with one more for the end. Prefix hashes never miss an equality, they may
    only report one too many: so ``same(a, b, length)`` compares the words themselves of each stretch, and a stretch that
    fails makes the batch start again with another base.
    """
    for seed in range(64):
        hashes = PrefixHashes(symbols, seed)
        found = [np.zeros((0, 3), np.int64)]
        for text, q, a in _grid(firsts, exponent):
            hit = symbols[a] == symbols[a + q]
            text, q, a = text[hit], q[hit], a[hit]
            b = a + q
            right = hashes.forward(a, b, firsts[text + 1] - b)
            left = hashes.backward(a, b, a - firsts[text])
            start, end = a - left, b + right
            long = end - start >= np.maximum(least, exponent * q)
            found.append(np.unique(np.column_stack([start, end, q])[long], axis=0))
        every = np.unique(np.concatenate(found), axis=0)
        # A stretch that has a period has its multiples, too: the smallest counts.
        fresh = np.ones(len(every), bool)
        fresh[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
        smallest = every[np.maximum.accumulate(np.where(fresh, np.arange(len(every)), 0)), 2] if len(every) else every[:, 2]
        own = every[fresh | (every[:, 2] % smallest > 0)]
        if all(same(s, s + q, e - q - s) for s, e, q in own.tolist()):
            order = np.lexsort((own[:, 2], own[:, 0]))
            return own[order, 0], own[order, 1], own[order, 2]
    raise ArithmeticError("no base tells these words apart")


def _batch(column: pa.Array, exponent: int, least: int) -> tuple[pa.Array, pa.Array]:
    """The runs and the collapsed text of each text."""
    raw, offsets = text_bytes(column)
    symbols, starts, ends, firsts = word_hashes(raw, offsets, lower=False)
    sizes = ends - starts
    # All words with a blank after each: a stretch of words is one stretch of these bytes.
    at = np.concatenate([[0], np.cumsum(sizes + 1)])
    joined = np.full(at[-1], 0x20, np.uint8)
    solid = np.ones(at[-1], bool)
    solid[at[1:] - 1] = False
    joined[solid] = raw[~SPACE[raw]]
    same = lambda a, b, n: at[a + n] - at[a] == at[b + n] - at[b] and np.array_equal(joined[at[a] : at[a + n]], joined[at[b] : at[b + n]])
    start, end, period = find_runs(symbols, firsts, same, exponent, least)
    change = np.zeros(len(sizes) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    kept = np.cumsum(change[:-1]) == 0
    text = np.searchsorted(firsts, start, "right") - 1
    bounds = np.searchsorted(text, np.arange(len(column) + 1))
    fields = [start - firsts[text], end - start, period]
    runs = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in fields], ["start", "length", "period"]))
    width = np.concatenate([[0], np.cumsum(np.where(kept, sizes + 1, 0))])[firsts]
    left = joined[np.repeat(kept, sizes + 1)].tobytes()
    collapsed = [left[a : b - 1].decode() if b > a else "" for a, b in zip(width[:-1].tolist(), width[1:].tolist())]
    return runs, pa.array(collapsed, pa.string())


def periodic_runs(docs: DataFrame, text: str = "text", exponent: int = 4, least: int = 6) -> DataFrame:
    """Runs of each text: stretches of at least ``exponent`` periods and ``least`` words that no neighbouring word extends.

    Words are the stretches between blanks and the controls from tab to carriage return, numbered from 0. A harmonic grid has, for each period, points of which every run holds
    one; all pairs of a point and the word one period later get their longest common extensions at once, by binary searches over prefix
    hashes; what is long enough is compared word by word (byte for byte), and each stretch is kept once, with its smallest period.

    Returns the columns of ``docs``, then ``runs`` (``array<struct<start, length, period>>`` by start, then period) and
    ``collapsed``: the words that no run holds after its first period, joined by one blank. Columns of these names are replaced. Null and empty
    texts have no runs and collapse to an empty text; texts are read whole; repeated rows are rows of their own; an empty
    table gives no rows. One pass without a shuffle: a worker holds some arrays over the words of a slice of about 2 MB, or of one longer text.
    """
    kept = [c for c in docs.columns if c not in ("runs", "collapsed")]
    read = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").alias("runs"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, done = batch.column(len(kept)), 0
            for part in row_groups(column):
                own = batch.slice(done, len(part))
                done += len(part)
                yield pa.RecordBatch.from_arrays([*own.columns[:-1], *_batch(part, exponent, least)], [*kept, "runs", "collapsed"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*(f"`{c}`" for c in kept)).schema), "runs array<struct<start: long, length: long, period: long>>", "collapsed string"])
    return mapped(read, find, schema)
