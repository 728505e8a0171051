"""Language of texts by sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundgrid.llm.common import balanced_sample, collected_texts, fold
from soundgrid.shipping import mapped

UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}").search
_OTHER = regex.compile(r"[^\p{L}\p{M}]+").sub
_STEPS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def grams(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of 1 to 3 characters of a text's lowered letters, words apart by blanks, and their counts."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0)
    letters = np.frombuffer((" " + _OTHER(" ", text.lower()) + " ").encode("utf-32-le"), np.uint32)
    found = []
    for n in (1, 2, 3):
        if len(letters) >= n:
            h = np.full(len(letters) - n + 1, n * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
            for j in range(n):
                h = (h ^ letters[j : j + len(h)]) * _STEPS[j]
                h ^= h >> np.uint32(15)
            found.append(h & np.uint32((1 << bits) - 1))
    counts = np.bincount(np.concatenate(found), minlength=1 << bits)
    own = np.flatnonzero(counts)
    return own, counts[own].astype(float)


@dataclass
class LanguageModel:
    classes: list[str]
    weights: np.ndarray
    bias: np.ndarray
    idf: np.ndarray
    bits: int
    temperature: float = 1.0

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        own, counts = grams(text, self.bits)
        x = (1 + np.log(counts)) * self.idf[own]
        return own, x / max(np.sqrt((x**2).sum()), 1e-12)

    def logits(self, text: str | None) -> np.ndarray:
        own, x = self.vector(text)
        return x @ self.weights[own] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.classes or not _LETTER(text):
            return UNDETERMINED, 0.0
        z = self.logits(text) / self.temperature
        p = np.exp(z - z.max())
        k = int(p.argmax())
        return self.classes[k], float(p[k] / p.sum())


def fit(texts: list[str], langs: list[str], idf: np.ndarray, bits: int, epochs: int = 3, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.01, l2: float = 0.01, held: int = 5, seed: int = 41) -> LanguageModel:
    """Follow the regularised leader, coordinate by coordinate, with elastic-net penalties; then fit the temperature.

    One text in ``held`` is kept from the weights and sets the temperature that gives its labels the greatest
    likelihood. Most weights stay exactly 0.
    """
    classes = sorted(set(langs))
    k = len(classes)
    model = LanguageModel(classes, np.zeros((1 << bits, k), np.float64), np.zeros(k), idf, bits)
    if not classes:
        return model
    order = np.random.default_rng(seed).permutation(len(texts))
    rest = order[: len(order) // held] if len(order) >= 2 * held else order[:0]
    own = order[len(rest) :]
    label = {c: i for i, c in enumerate(classes)}
    rows = {i: (*model.vector(texts[i]), label[langs[i]]) for i in order.tolist()}
    z, n = np.zeros((1 << bits, k)), np.zeros((1 << bits, k))
    zb, nb = np.zeros(k), np.zeros(k)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)

    for _ in range(epochs):
        for i in own.tolist():
            at, x, y = rows[i]
            zi, ni = z[at], n[at]
            w, wb = weights(zi, ni), weights(zb, nb)
            p = np.exp((s := x @ w + wb) - s.max())
            p /= p.sum()
            p[y] -= 1
            g = x[:, None] * p
            after = ni + g**2
            z[at] = zi + g - (np.sqrt(after) - np.sqrt(ni)) / alpha * w
            n[at] = after
            after = nb + p**2
            zb, nb = zb + p - (np.sqrt(after) - np.sqrt(nb)) / alpha * wb, after
    model.weights, model.bias = weights(z, n), weights(zb, nb)
    if len(rest):
        s = np.array([rows[i][1] @ model.weights[rows[i][0]] + model.bias for i in rest.tolist()])
        y = np.array([rows[i][2] for i in rest.tolist()])

        def loss(t: float) -> float:
            a = s / t
            a = a - a.max(axis=1, keepdims=True)
            return float((np.log(np.exp(a).sum(axis=1)) - a[np.arange(len(y)), y]).mean())

        model.temperature = float(min(np.geomspace(0.05, 5, 101), key=loss))
    return model


def document_frequencies(docs: DataFrame, bits: int, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many texts each hashed n-gram occurs, over all rows, and the number of texts. Each task sends its own sums once."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, texts = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                count[grams(t, bits)[0]] += 1
                texts += 1
        own = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *own], pa.int32()), pa.array([texts, *count[own]], pa.int64())], ["gram", "n"])

    found = mapped(docs.select(text), sums, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    count = np.zeros((1 << bits) + 1, np.int64)
    count[found["gram"].to_numpy()] = found["n"].to_numpy()  # the texts' own number comes last
    return count[:-1], int(count[-1])


def train(docs: DataFrame, limit: int = 4_000, byte_limit: int = 16 << 20, folds: int = 4, left_out: int = 2, bits: int = 15, seed: int = 43, **options) -> LanguageModel:
    """Train on documents with text, language and id outside fold ``left_out`` (``crc32(doc_id) mod folds``).

    Document frequencies count all those documents; weights are fitted on at most about ``limit`` of them, chosen by a
    seeded hash of the id, as many of each language (all of a rare one), and on at most ``byte_limit`` bytes of their texts, which bounds what is collected.
    """
    # Repeated rows of an id count once in the sample; an empty table gives a model that knows no language.
    known = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id"), folds) != left_out)).select("doc_id", "text", "lang")
    count, n = document_frequencies(known, bits)
    ids = balanced_sample(known.groupBy("doc_id").agg(F.min("lang").alias("lang")), "doc_id", "lang", limit, seed).select("doc_id")
    rows = known.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("row")).select("doc_id", "row.*")
    rows = collected_texts(rows, "doc_id", "text", byte_limit, seed)
    return fit([r["text"] for r in rows], [r["lang"] for r in rows], np.log((1 + n) / (1 + count)) + 1, bits, **options)


def languages(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, ``lang_pred`` and ``lang_score``, its calibrated probability.

    Whole texts are read. A null text, or one without a letter, is ``und`` with score 0, and so is every text if the model
    has learned no language. Input columns of the new names are replaced; repeated rows are predicted each, an empty table gives no rows. One pass without a shuffle.
    """
    kept = [c for c in docs.columns if c not in (text, "lang_pred", "lang_score")]
    docs = docs.select(*kept, F.col(text).alias("lang_pred"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("lang_pred")
            found = [shared.value.predict(t) for t in batch.column(at).to_pylist()]
            columns = [*batch.columns[:at], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "lang_score"])

    return mapped(docs, predict, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema), "lang_pred string", "lang_score double"]))
