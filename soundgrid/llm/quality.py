"""Quality of texts by a generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundgrid.llm.common import bounded_sample, fold
from soundgrid.llm.words import row_groups, shingles, text_bytes, word_hashes
from soundgrid.shipping import mapped

_CLASSES = np.zeros((256, 7), bool)
_CLASSES[ord("A") : ord("Z") + 1, 0] = 1
_CLASSES[ord("a") : ord("z") + 1, 1] = 1
_CLASSES[0x80:, 1] = 1
_CLASSES[ord("0") : ord("9") + 1, 2] = 1
_CLASSES[list(b".,;:?'\"()-"), 3] = 1
_CLASSES[list(b"#$%&*@^~<>{}[]\\/_=+`"), 4] = 1
_CLASSES[list(b"!|"), 5] = 1
_CLASSES[list(b"\n\r"), 6] = 1
_CLASS_OF = np.where(_CLASSES.any(axis=1), _CLASSES.argmax(axis=1), 7).astype(np.uint8)
FEATURES = ["log_bytes", "word_length", "longest_word", "upper", "digit", "point", "symbol", "mark", "line_length", "distinct_words", "top_word", "distinct_shingles", "marked_words", "upper_words"]


def features(column: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` for each text; those of null and empty texts are 0."""
    return np.concatenate([np.zeros((0, len(FEATURES))), *map(_features, row_groups(column))])


def _features(column: pa.Array) -> np.ndarray:
    raw, offsets = text_bytes(column)
    out = np.zeros((len(column), len(FEATURES)))
    if not len(raw):
        return out
    kind = _CLASS_OF[raw]
    filled = np.flatnonzero(np.diff(offsets))
    count = np.zeros((7, len(column)), np.int64)
    for k in (0, 2, 3, 4, 5, 6):
        count[k, filled] = np.add.reduceat(kind == k, offsets[filled], dtype=np.int64)
    upper, _, digit, point, symbol, mark, line = count
    hashes, starts, ends, firsts = word_hashes(raw, offsets)
    within = lambda flags: (c := np.concatenate([[0], np.cumsum(flags, dtype=np.int32)]))[ends] - c[starts]
    per_text = lambda values: (c := np.concatenate([[0], np.cumsum(values)]))[firsts[1:]] - c[firsts[:-1]]
    marked = within((kind == 4) | (kind == 5)) > 0
    shout = (within(kind == 0) > 1) & (within(kind == 1) == 0)
    size, words, length = np.diff(offsets), np.maximum(np.diff(firsts), 1), ends - starts
    for i, own in enumerate(shingles(hashes, firsts)):
        a, b = firsts[i], firsts[i + 1]
        if b > a:
            _, same = np.unique(hashes[a:b], return_counts=True)
            out[i, 2] = min(length[a:b].max(), 1000)
            out[i, 9:12] = len(same) / (b - a) ** 0.9, same.max() / (b - a), len(own) / max(b - a - 4, 1)
    out[:, 0] = np.log1p(size)
    out[:, 1] = per_text(length) / words
    out[:, 3:8] = np.column_stack([upper, digit, point, symbol, mark]) / np.maximum(size, 1)[:, None]
    out[:, 8] = np.log1p(size / (line + 1))
    out[:, 12] = per_text(marked) / words
    out[:, 13] = per_text(shout) / words
    return out


@dataclass
class AdditiveModel:
    """Lookup tables over bins: one for each feature, one for each chosen pair of features."""

    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)])

    def logits(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[b[:, j]]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[b[:, i], b[:, j]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _leaf(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g / (h + ridge)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """A shallow tree over one feature's ordered bins: the value of each bin's leaf."""
    bounds = [0, len(g)]
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    gain_of = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + ridge)
    while len(bounds) <= leaves:
        best, where = 1e-9, None
        for a, b in zip(bounds, bounds[1:]):
            if b - a > 1:
                cut = np.arange(a + 1, b)
                gain = gain_of(a, cut) + gain_of(cut, b) - gain_of(a, b)
                k = int(gain.argmax())
                if gain[k] > best:
                    best, where = gain[k], int(cut[k])
        if where is None:
            break
        bounds = sorted([*bounds, where])
    out = np.empty(len(g))
    for a, b in zip(bounds, bounds[1:]):
        out[a:b] = _leaf(cg[b] - cg[a], ch[b] - ch[a], ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """The best tree of one cut on each of two features: its leaves' values and its gain."""
    cg, ch = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0))), np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    n, m = g.shape
    if n < 2 or m < 2:
        return np.zeros_like(g), 0.0
    i, j = np.arange(1, n)[:, None], np.arange(1, m)[None, :]
    parts = lambda c: (c[i, j], c[i, m] - c[i, j], c[n, j] - c[i, j], c[n, m] - c[i, m] - c[n, j] + c[i, j])
    gain = sum(a**2 / (b + ridge) for a, b in zip(parts(cg), parts(ch)))
    r, c = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.zeros_like(g)
    for rows, columns in ((slice(0, r + 1), slice(0, c + 1)), (slice(0, r + 1), slice(c + 1, m)), (slice(r + 1, n), slice(0, c + 1)), (slice(r + 1, n), slice(c + 1, m))):
        out[rows, columns] = _leaf(g[rows, columns].sum(), h[rows, columns].sum(), ridge)
    return out, float(gain[r, c] - cg[n, m] ** 2 / (ch[n, m] + ridge))


def fit(x: np.ndarray, y: np.ndarray, max_bins: int = 32, rounds: int = 120, rate: float = 0.15, leaves: int = 3, pairs: int = 6, ridge: float = 1.0) -> AdditiveModel:
    """Cyclic boosting: in each round every feature in turn gets one shallow tree on what is left to explain, added to its table.

    Then the pairs of features whose best tree explains most of the rest get tables in the same way. Bins are
    quantiles of the training rows. One label alone gives an intercept and empty tables.
    """
    n = len(y)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, max_bins + 1)[1:-1])) if n else np.zeros(0) for j in range(x.shape[1])]
    rate_of_one = (y.sum() + 0.5) / (n + 1)
    model = AdditiveModel(edges, float(np.log(rate_of_one / (1 - rate_of_one))), [np.zeros(len(e) + 1) for e in edges])
    if not n or y.min() == y.max():
        return model
    b = model.bins(x)
    total = np.full(n, model.intercept)
    slope = lambda: (y - (p := 1 / (1 + np.exp(-np.clip(total, -30, 30)))), p * (1 - p))
    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            g, h = slope()
            step = rate * _tree(np.bincount(b[:, j], g, len(table)), np.bincount(b[:, j], h, len(table)), leaves, ridge)
            table += step
            total += step[b[:, j]]

    def histograms(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        shape = len(model.tables[i]), len(model.tables[j])
        at = b[:, i] * shape[1] + b[:, j]
        g, h = slope()
        return tuple(np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

    ranked = sorted(((_quadrants(*histograms(i, j), ridge)[1], i, j) for i in range(len(edges)) for j in range(i)), reverse=True)
    model.pairs = [(i, j) for gain, i, j in ranked[:pairs] if gain > 0]
    model.pair_tables = [np.zeros((len(model.tables[i]), len(model.tables[j]))) for i, j in model.pairs]
    for _ in range(rounds // 4):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            step = rate * _quadrants(*histograms(i, j), ridge)[0]
            table += step
            total += step[b[:, i], b[:, j]]
    return model


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, and ``quality_features``."""
    kept = [c for c in docs.columns if c not in (text, "quality_features")]
    docs = docs.select(*kept, F.col(text).alias("quality_features"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("quality_features")
            x = features(batch.column(at))
            made = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], made], batch.schema.names)

    return mapped(docs, run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema), "quality_features array<double>"]))


def train(docs: DataFrame, labels: DataFrame, limit: int = 20_000, folds: int = 5, seed: int = 37, **options) -> AdditiveModel:
    """Train on labelled documents outside fold 0 (``crc32(doc_id) mod folds``).

    At most about ``limit`` labelled documents are used, chosen by a seeded hash of the id: this bounds the broadcast ids
    and the collected features (``len(FEATURES)`` numbers a row). An id with several labels takes the largest; one with
    several texts keeps the features of one row.
    """
    known = labels.filter(F.col("quality").isNotNull() & (fold(F.col("doc_id"), folds) != 0)).groupBy("doc_id").agg((F.max("quality") > 0).cast("int").alias("label"))
    sample = bounded_sample(known, "doc_id", limit, seed)
    rows = with_features(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")).groupBy("doc_id", "label").agg(F.min("quality_features").alias("x")).orderBy("doc_id").toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, rows["label"].to_numpy(float), **options)


def quality(docs: DataFrame, model: AdditiveModel, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, and ``quality_score``: the probability of label 1 by the tables of the text's bins.

    Whole texts are read. Null and empty texts have the score of features that are all 0. An input column of the new
    name is replaced; repeated rows are scored each, an empty table gives no rows. One pass without a shuffle. (Words count as 1,000 bytes long at most, a bin's end.)
    """
    kept = [c for c in docs.columns if c not in (text, "quality_score")]
    docs = docs.select(*kept, F.col(text).alias("quality_score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("quality_score")
            own = shared.value.scores(features(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(own, pa.float64())], batch.schema.names)

    return mapped(docs, score, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema), "quality_score double"]))
