"""Whitening of embeddings: principal axes by cyclic Jacobi rotations of a distributed scatter matrix."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundgrid.shipping import mapped

_ROWS = 4096


@dataclass
class Whitening:
    """What ``fit`` learns: ``axes`` are rows, by falling eigenvalue."""

    n: int
    sums: list
    eigenvalues: np.ndarray
    axes: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def explained(self) -> np.ndarray:
        total = self.eigenvalues.sum()
        return self.eigenvalues / total if total > 0 else np.zeros(len(self.eigenvalues))

    def rank(self) -> int:
        """Axes whose variance isn't zero to double precision; the others can't be scaled to one."""
        top = self.eigenvalues[0] if len(self.eigenvalues) else 0.0
        return int((self.eigenvalues > max(top, 0.0) * len(self.eigenvalues) * np.finfo(float).eps).sum())

    def matrix(self, components: int) -> np.ndarray:
        """The whitening matrix, a column for each of the first components that can be scaled."""
        k = min(components, self.rank())
        return (self.axes[:k] / np.sqrt(self.eigenvalues[:k])[:, None]).T


def _rounds(d: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of ``d`` indices once, in rounds of disjoint pairs: one cycle."""
    seats = list(range(d + d % 2))
    out = []
    for _ in range(len(seats) - 1):
        pairs = [(min(p, q), max(p, q)) for p, q in zip(seats[: len(seats) // 2], reversed(seats)) if max(p, q) < d]
        out.append((np.array([p for p, _ in pairs]), np.array([q for _, q in pairs])))
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return out


def jacobi(matrix: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix by falling size, and unit eigenvectors as rows, by cyclic Jacobi rotations.

    A sweep meets every pair once; the disjoint pairs of a round turn together. A pair rests when its element is below the
    last digit of the geometric mean of its two diagonal elements, a bound relative to both, which keeps small eigenvalues of
    a positive definite matrix accurate; the sweeps end when all rest. Of either sign the one whose largest entry is positive is chosen.
    """
    a = np.array(matrix, np.float64)
    d = len(a)
    v = np.eye(d)
    rounds = _rounds(d) if d > 1 else []
    floor = np.finfo(float).tiny
    for _ in range(sweeps):
        turned = False
        for p, q in rounds:
            app, aqq, apq = a[p, p], a[q, q], a[p, q]
            busy = np.abs(apq) > np.maximum(np.finfo(float).eps * np.sqrt(np.abs(app * aqq)), floor)
            if not busy.any():
                continue
            turned = True
            p, q, app, aqq, apq = p[busy], q[busy], app[busy], aqq[busy], apq[busy]
            theta = (aqq - app) / (2 * apq)
            t = np.where(theta < 0, -1.0, 1.0) / (np.abs(theta) + np.hypot(theta, 1.0))
            c = 1 / np.sqrt(t * t + 1)
            s = t * c
            for m in (a, v):
                left, right = m[:, p].copy(), m[:, q].copy()
                m[:, p], m[:, q] = c * left - s * right, s * left + c * right
            left, right = a[p].copy(), a[q].copy()
            a[p], a[q] = c[:, None] * left - s[:, None] * right, s[:, None] * left + c[:, None] * right
            a[p, p], a[q, q] = app - t * apq, aqq + t * apq
            a[p, q] = a[q, p] = 0.0
        if not turned:
            break
    values = np.diag(a).copy()
    order = np.argsort(-values, kind="stable")
    axes = v.T[order]
    largest = axes[np.arange(d), np.abs(axes).argmax(axis=1)] if d else np.zeros(0)
    return values[order], axes * np.where(largest < 0, -1.0, 1.0)[:, None]


def _matrices(column: pa.Array, d: int) -> Iterator[np.ndarray]:
    """Rows of an array column without nulls, some at a time, as a matrix of doubles or longs."""
    for a in range(0, len(column), _ROWS):
        part = column.slice(a, _ROWS)
        yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), d)


def _summed(df: DataFrame, function, kind: str) -> DataFrame:
    """What the tasks of ``function`` sum up, each in one array of its own, added by place."""
    parts = mapped(df, function, f"cells array<{kind}>")
    return parts.select(F.posexplode("cells")).groupBy("pos").agg(F.sum("col").alias("total"))


def usable(vector: str | Column) -> Column:
    """Vectors that aren't null and hold no null or non-finite component."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def dimension(df: DataFrame, vector: str = "vector") -> int:
    """The length that most usable vectors have, the greater of equally frequent ones; 0 without any."""
    size = F.size(vector).alias("d")
    top = df.filter(usable(vector)).groupBy(size).count().orderBy(F.desc("count"), F.desc("d")).first()
    return top["d"] if top else 0


def _second_moments(rows: DataFrame, d: int, shift: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``(x - shift) @ turn`` and of its products: each task adds up its own, then they meet by place."""
    k = turn.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast((shift, turn))

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, turn = shared.value
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for x in _matrices(batch.column(0), d):
                y = (x - shift) @ turn
                sums += y.sum(axis=0)
                products += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([sums, products.ravel()])], pa.list_(pa.float64()))], ["cells"])

    cells = np.zeros(k + k * k)
    found = _summed(rows, moments, "double").toArrow()
    cells[found.column("pos").to_numpy()] = found.column("total").to_numpy()
    return cells[:k], cells[k:].reshape(k, k)


def fit(df: DataFrame, vector: str = "vector") -> Whitening:
    """Mean and principal axes of all usable vectors of the most frequent length.

    Two passes: sums by dimension (exact for integer components, whose sum must stay below 2^63), then the scatter of what is left after
    the mean is taken off. Each task sends one matrix, and they are added up by place; the driver gets ``d * d`` numbers and turns
    them by ``jacobi``, so a few thousand dimensions are its bound. The covariance divides by the number of vectors.
    """
    d = dimension(df, vector)
    if d == 0:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)))
    rows = df.filter(usable(vector) & (F.size(vector) == d)).select(F.col(vector).alias("vector"))
    kind = rows.schema["vector"].dataType.elementType.typeName()
    whole = kind in ("byte", "short", "integer", "long")
    rows = rows.select(F.col("vector").cast("array<long>" if whole else "array<double>").alias("vector"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(d, np.int64 if whole else np.float64), 0
        for batch in batches:
            n += batch.num_rows
            for x in _matrices(batch.column(0), d):
                total += x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([[*total.tolist(), n if whole else float(n)]], pa.list_(pa.int64() if whole else pa.float64()))], ["cells"])

    found = {r["pos"]: r["total"] for r in _summed(rows, sums, "long" if whole else "double").collect()}
    n = int(found.get(d, 0))
    model = Whitening(n, [found[i] for i in range(d)], np.zeros(d), np.eye(d))
    _, scatter = _second_moments(rows, d, model.mean, np.eye(d))
    model.eigenvalues, model.axes = jacobi((scatter + scatter.T) / (2 * n))
    return model


def whitened(df: DataFrame, model: Whitening, components: int, vector: str = "vector") -> DataFrame:
    """Usable vectors of the model's length, less the mean, on the first ``components`` axes, each scaled to variance one.

    Returns the rows and columns of ``df`` with ``whitened array<double>``; a column of that name is replaced. Null vectors and
    those with null or non-finite components, or of another length than the model's, go; repeated rows and null ids stay. Axes without
    variance can't be scaled and are left out, so constant vectors give empty arrays; an empty table gives no rows. No shuffle: the matrix is broadcast
    (``d * components`` numbers).
    """
    d = len(model.sums)
    kept = [c for c in df.columns if c != "whitened"]
    rows = df.filter(usable(vector) & (F.size(vector) == d) & F.lit(d > 0))
    read = rows.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{vector}`").cast("array<double>").alias("whitened"))
    shared = df.sparkSession.sparkContext.broadcast((model.mean if d else np.zeros(0), model.matrix(components)))

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, matrix = shared.value
        for batch in batches:
            out = np.concatenate([np.zeros((0, matrix.shape[1])), *((x - mean) @ matrix for x in _matrices(batch.column(len(kept)), d))])
            bounds = pa.array(np.arange(len(out) + 1, dtype=np.int32) * matrix.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(bounds, pa.array(out.ravel(), pa.float64()))], batch.schema.names)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-1]), "whitened array<double>"])
    return mapped(read, turn, schema)


def identity_error(df: DataFrame, model: Whitening, components: int, vector: str = "vector") -> float:
    """The largest entry of the whitened vectors' covariance less the identity, measured over all rows that the model takes; 0 without any.

    Vectors are centred before they are multiplied, and what is left of the mean is taken off the products.
    """
    matrix, d = model.matrix(components), len(model.sums)
    if not model.n or not matrix.shape[1]:
        return 0.0
    rows = df.filter(usable(vector) & (F.size(vector) == d)).select(F.col(vector).cast("array<double>").alias("vector"))
    sums, products = _second_moments(rows, d, model.mean, matrix)
    mean = sums / model.n
    return float(np.abs(products / model.n - np.outer(mean, mean) - np.eye(len(mean))).max())
