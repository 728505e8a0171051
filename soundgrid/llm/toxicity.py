"""Toxicity of texts by compression distance to two zstandard dictionaries."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundgrid.llm.common import bounded_sample, bounded_texts, discard, fitted, fold
from soundgrid.shipping import mapped

#: Matches of six bytes or more and literals as they are, so that a known word shows in a window's length by all its bytes.
_PARAMETERS = {"strategy": zstandard.STRATEGY_FAST, "target_length": 1, "min_match": 6, "hash_log": 18, "chain_log": 6, "search_log": 1, "window_log": 18, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
#: Follows every window, so that none is stored as it is for being too little compressible, which would hide what a dictionary saves.
_PAD = b"\n" * 96
FEATURES = 6


def words(text: str) -> list[bytes]:
    return text.lower().encode().split()


def windows(text: str, size: int) -> Iterator[bytes]:
    """A text's words, lowered, in windows of at least ``size`` bytes; no word is cut."""
    data = b" " + b" ".join(words(text)) + b" "
    at = 0
    while at < len(data) - 1:
        end = data.find(b" ", at + size)
        end = len(data) - 1 if end < 0 else end
        yield data[at : end + 1]
        at = end


@dataclass
class ToxicityModel:
    """Dictionaries over one base, and the calibration.

    ``ordinary`` is what ordinary text has. ``toxic`` holds two additions to it: what only toxic texts spell, and what only toxic
    texts have as words, though its spelling also runs through ordinary ones.
    """

    ordinary: bytes
    toxic: tuple[bytes, bytes]
    weights: np.ndarray
    window: int
    base_rate: float

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "compressors"}

    @cached_property
    def compressors(self) -> tuple:
        made = []
        for content in (self.ordinary, *(self.ordinary + t for t in self.toxic)):
            parameters = zstandard.ZstdCompressionParameters(**_PARAMETERS)
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters).compress)
        return tuple(made)

    def gains(self, text: str) -> list[tuple[int, int]]:
        """Bytes that either toxic dictionary saves over the ordinary one, window by window."""
        plain, clear, mixed = self.compressors
        return [((n := len(plain(w + _PAD))) - len(clear(w + _PAD)), n - len(mixed(w + _PAD))) for w in windows(text, self.window)]

    def features(self, text: str | None) -> list[float]:
        gains = self.gains(text or "")
        clear, mixed = (sorted((g[k] for g in gains), reverse=True) + [0, 0] for k in (0, 1))
        strength = lambda values: float(np.sqrt(sum(g for g in values if g > 2)))
        return [clear[0], max(clear[1], 0), strength(clear), mixed[0], strength(mixed), float(np.log1p(len(gains)))]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not any(self.toxic):
            return np.full(len(texts), self.base_rate)
        x = np.array([self.features(t) for t in texts], float).reshape(-1, FEATURES)
        return 1 / (1 + np.exp(-np.clip(np.column_stack([x, np.ones(len(x))]) @ self.weights, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the intercept, which ``ridge`` leaves alone."""
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(texts: list[str], toxic: np.ndarray, rates: tuple[float, float], window: int = 128, base_bytes: int = 1 << 16, least_bytes: int = 2048, contexts: int = 4, segments: tuple[tuple[int, int], ...] = ((24, 6), (32, 6), (48, 6), (24, 8))) -> ToxicityModel:
    """Train both dictionaries and calibrate.

    The ordinary dictionary is zstandard's, trained on windows of ordinary texts. Toxic texts are ordinary but for some
    words, so the toxic dictionaries are trained on what sets them apart: on each toxic text's words that stand
    after ``contexts`` different words at least over all toxic texts (which copies of one text don't reach) and are
    twenty times rarer in ordinary texts. Words of which no six bytes run through a thousandth of the ordinary texts make the
    first toxic dictionary, the others the second; each is trained with room for all its words, ``least_bytes`` at least, and has every one of them. Both are added to the ordinary one, so a window without such words
    has the same length under all. ``rates`` are all labelled rows over those in the sample, ordinary and toxic: they
    bring the calibration back to the labels' own proportions. Which segments a small dictionary gets depends on the trainer's
    segment and piece lengths, so each of ``segments`` is tried and the one with the least loss on the sample stays.
    """
    base_rate = float(rates[1] * toxic.sum() / max(rates[0] * (toxic == 0).sum() + rates[1] * toxic.sum(), 1e-9))
    nothing = ToxicityModel(b"", (b"", b""), np.zeros(FEATURES + 1), window, base_rate)
    if not toxic.any() or toxic.all():
        return nothing
    plain, marked = Counter(), Counter()
    for t, label in zip(texts, toxic):
        (marked if label else plain).update(set(words(t)))
    rare = {w for w, n in marked.items() if n >= contexts and plain[w] * 20 < n}
    before: dict[bytes, set] = defaultdict(set)
    residues = []
    for t, label in zip(texts, toxic):
        if label:
            own = words(t)
            for a, b in zip([b"", *own], own):
                if b in rare:
                    before[b].add(a)
            residues.append([w for w in own if w in rare])
    telling = {w for w, a in before.items() if len(a) >= contexts and plain[w] * 20 < len(a)}
    pieces = lambda w: {(w := b" " + w + b" ")[i : i + 6] for i in range(max(len(w) - 5, 1))}
    spelled = dict.fromkeys((p for w in telling for p in pieces(w)), 0)
    for w, n in plain.items():
        for p in pieces(w):
            if p in spelled:
                spelled[p] += n
    shared = {w for w in telling if max(spelled[p] for p in pieces(w)) * 1000 > (toxic == 0).sum()}
    room = [max(least_bytes, sum(len(w) + 2 for w in some)) for some in (telling - shared, shared)]
    samples = [[b" " + b"  ".join(kept) + b" " for own in residues if (kept := [w for w in own if w in some])] for some in (telling - shared, shared)]
    del plain, marked, rare, before, spelled, residues  # the trainer needs the room
    ordinary = [w for t, label in zip(texts, toxic) if not label for w in windows(t, 256)]
    if not any(samples) or not ordinary:
        return nothing

    def trained(samples: list[bytes], size: int, k: int, d: int) -> bytes:
        try:  # too few samples train nothing; their own bytes are then the dictionary
            return zstandard.train_dictionary(size, samples, k=k, d=d).as_bytes()[-size:]
        except zstandard.ZstdError:
            return b"".join(samples)[-size:]

    def whole(own: list[bytes], some: set[bytes], size: int, k: int, d: int) -> bytes:
        """The trained dictionary, behind those words for which the trainer chose no segment."""
        found = trained(own, size, k, d)
        return b"".join(b" " + w + b" " for w in sorted(some) if w not in found) + found

    base, weight = trained(ordinary, base_bytes, 256, 8), np.where(toxic, rates[1], rates[0])
    best, least = nothing, np.inf
    for k, d in segments:
        model = ToxicityModel(base, tuple(whole(own, some, size, k, d) for own, some, size in zip(samples, (telling - shared, shared), room)), np.zeros(FEATURES + 1), window, base_rate)
        x = np.array([model.features(t) for t in texts], float)
        model.weights = logistic(x, toxic.astype(float), weight)
        z = np.clip(np.column_stack([x, np.ones(len(x))]) @ model.weights, -30, 30)
        loss = float((weight * (np.logaddexp(0, z) - toxic * z)).sum())
        if loss < least:
            best, least = model, loss
    return best


def train(docs: DataFrame, labels: DataFrame, toxic_limit: int = 2500, ordinary_limit: int = 5000, byte_limit: int = 32 << 20, folds: int = 5, seed: int = 31, **options) -> ToxicityModel:
    """Train on labelled documents outside fold 0 (``crc32(doc_id) mod folds``).

    At most about ``toxic_limit`` toxic and ``ordinary_limit`` ordinary documents are used, chosen by a seeded hash of the
    id, and at most ``byte_limit`` bytes of their texts; these bounds make the sample's ids a bounded broadcast and its texts a bounded task, which fits the model. An id with several
    labels takes the largest, an id with several texts the smallest; repeated rows count once. Without labels of both kinds every score is the base rate.
    """
    known = labels.filter(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), folds) != 0))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")).cache()
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    sample = bounded_sample(known.filter("toxic"), "doc_id", toxic_limit, seed).unionByName(bounded_sample(known.filter("not toxic"), "doc_id", ordinary_limit, seed))
    rows = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = bounded_texts(rows, "doc_id", "text", byte_limit, seed)
    known.unpersist()

    def model(own: list[dict]) -> ToxicityModel:
        toxic = np.array([r["toxic"] for r in own], bool)
        rates = tuple(counts.get(k, 0) / max(int((toxic == k).sum()), 1) for k in (False, True))
        return fit([r["text"] for r in own], toxic, rates, **options)

    found = fitted(rows, "doc_id", model)
    discard(rows)
    return found


def toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The columns of ``docs`` and ``toxicity_score``, the probability that a text is toxic, from its windows' lengths under both dictionaries.

    Whole texts of any length are read, window by window. Null and empty texts have no window and the score of that.
    An input column of the new name is replaced; repeated rows are scored each, an empty table gives no rows. One pass without a shuffle.
    """
    docs = docs.drop("toxicity_score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = shared.value.scores(batch.column(batch.schema.get_field_index(text)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.float64())], [*batch.schema.names, "toxicity_score"])

    return mapped(docs, score, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "toxicity_score double"]))
