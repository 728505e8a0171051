"""Words of whole Arrow batches as 64-bit hashes, without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_rng = np.random.default_rng(5)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Each byte's random value, for texts as they are and for texts with A-Z lowered.
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE_LOWER = _VALUE[_LOWER]
_BASE = int(_rng.integers(1 << 60, 1 << 61)) * 8 + 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 18
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser after which all bits of a 64-bit value depend on all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers_of(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, _CHUNK + 1), np.uint64(base), np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 4 * _CHUNK:
            _powers[base] = have
    return have[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, one text after the other, and where each text starts (one more for the end). Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def row_groups(column: pa.Array, limit: int = 1 << 21) -> Iterator[pa.Array]:
    """Slices of a string column with about ``limit`` bytes at most; a longer text is a slice of its own. Bounds what arrays per byte need."""
    _, offsets = text_bytes(column)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield column.slice(a, b - a)
        a = b


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word ``[^\\x20\\x09-\\x0D]+``, and the first word of each text (one more for the end).

    The hash is a polynomial of random byte values modulo 2^64, read off running sums, so a word's cost is
    that of its bytes. Sums run over pieces of ``_CHUNK`` bytes that end between words; a longer word is a piece of its own.
    """
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    solid = ~SPACE[raw]
    edge = np.zeros(n + 1, bool)  # a text starts or ends here
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:n]
    stops = solid
    stops[:-1] &= ~solid[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    value = _VALUE_LOWER if lower else _VALUE
    hashes = np.empty(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        low = starts[k]
        last = max(k + 1, int(np.searchsorted(ends, low + _CHUNK, "right")))
        high = ends[last - 1]
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(value[raw[low:high]] * _powers_of(_BASE, high - low), out=sums[1:])
        s = starts[k:last] - low
        hashes[k:last] = (sums[ends[k:last] - low] - sums[s]) * _powers_of(_INVERSE, high - low)[s]
        k = last
    return mix(hashes), starts, ends, np.searchsorted(starts, offsets)


_STEPS = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(hashes: np.ndarray, firsts: np.ndarray, width: int = 5) -> Iterator[np.ndarray]:
    """For each text, its distinct shingles of ``width`` words as sorted hashes.

    A text of fewer words has its whole sequence as its one shingle, a text without words has none.
    """
    every = np.zeros(max(len(hashes) - width + 1, 0), np.uint64)
    for j in range(width):
        every += hashes[j : len(every) + j] * _STEPS[j]
    every = mix(every)
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= width:
            yield np.unique(every[a : b - width + 1])
        elif b > a:
            yield mix((hashes[a:b] * _STEPS[: b - a]).sum(keepdims=True) + _STEPS[width + b - a])
        else:
            yield np.zeros(0, np.uint64)
