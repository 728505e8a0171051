"""Approximate nearest neighbours by largest inner product over randomly rotated one-bit codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soundgrid.llm.common import written
from soundgrid.shipping import ship

#: Bits of a rotated query's components; a code's inner product with it is so many counts of common bits.
QUERY_BITS = 4
#: Queries that are scored against a block of codes at once.
_CHUNK = 256


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def usable(vector: str, dim: int | None = None) -> Column:
    """The vector isn't null, has only finite components, is not zero, and has the dimension."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0) & (F.size(v) == dim if dim else F.lit(True))


def packed_bits(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    short = np.packbits(bits, axis=-1)
    return np.pad(short, [(0, 0)] * (short.ndim - 1) + [(0, -short.shape[-1] % 8)]).view(np.uint64)


def scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each row's sum by itself, so that equal vectors have equal scores wherever they are."""
    return (x.astype(np.float64) * q).sum(axis=1)


def index(vectors: DataFrame, blocks: int, centre: np.ndarray, seed: int) -> DataFrame:
    """The vectors dealt by a seeded hash into ``blocks``, encoded, one row a block: ``block, ids, codes, lengths, factors, vectors``, all packed.

    A vector less the centre is rotated and only its components' signs are kept, a bit each. Two scalars correct what
    that loses: the residual's length, and the inner product of the unit residual with its own code.
    """
    dim = len(centre)
    turn = rotation(dim, seed)
    ship(vectors.sparkSession)

    def encode(own: pa.Table) -> pa.Table:
        x = own.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(own), dim)
        residual = x.astype(np.float64) - centre
        length = np.linalg.norm(residual, axis=1)
        turned = residual @ turn / np.maximum(length, 1e-300)[:, None]
        factor = np.abs(turned).sum(axis=1) / np.sqrt(dim)
        packed = (own.column("vec_id").to_numpy(), packed_bits(turned > 0), length, np.where(length > 0, factor, 1.0), x)
        return pa.table([own.column("block").combine_chunks().slice(0, 1), *(pa.array([p.tobytes()], pa.binary()) for p in packed)], ["block", "ids", "codes", "lengths", "factors", "vectors"])

    dealt = vectors.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "vec_id", "embedding"), F.lit(max(blocks, 1))).cast("int"))
    return dealt.groupBy("block").applyInArrow(encode, "block int, ids binary, codes binary, lengths binary, factors binary, vectors binary")


def estimates(turned: np.ndarray, codes: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of rotated queries with codes (components of one over the root of ``dim``, with the bit's sign), and the deviation that the queries' bits bring.

    A query's components are rounded to ``QUERY_BITS`` bits between its least and greatest one; bit by bit of these, the ones in common
    with a code are counted.
    """
    low, high = turned.min(axis=1, keepdims=True), turned.max(axis=1, keepdims=True)
    step = np.maximum(high - low, 1e-300) / ((1 << QUERY_BITS) - 1)
    level = np.rint((turned - low) / step).astype(np.uint8)
    planes = packed_bits((level[None] >> np.arange(QUERY_BITS, dtype=np.uint8)[:, None, None] & 1).astype(bool))
    common = np.zeros((len(turned), len(codes)), np.int32)
    for word in range(codes.shape[1]):
        for j in range(QUERY_BITS):
            common += np.bitwise_count(planes[j, :, word][:, None] & codes[None, :, word]).astype(np.int32) << j
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int32)
    total = level.sum(axis=1, dtype=np.int32)[:, None]
    # Of the components, those with the bit add their value, the others take it away.
    signed = low * (2 * ones[None, :] - dim) + step * (2 * common - total)
    return (signed / np.sqrt(dim)).astype(np.float32), (step[:, 0] / np.sqrt(12)).astype(np.float32)


def search_block(queries: np.ndarray, query_ids: np.ndarray, centre: np.ndarray, turn: np.ndarray, ids: np.ndarray, codes: np.ndarray, length: np.ndarray, factor: np.ndarray, x: np.ndarray, k: int, epsilon: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's ``k`` nearest in one block: positions of queries, ids and exact scores.

    The code's inner product with the rotated query, over the code's own with its vector, estimates the vector's inner
    product without bias; with the correction scalars comes a bound on the error that holds but for a chance that falls
    as ``exp(-epsilon^2)``. A vector is reranked by its exact inner product if its upper bound reaches the ``k``-th greatest lower bound.
    Vectors equal to another of the block share one code; of their ids the ``k + 1`` smallest can be among the nearest.
    """
    dim = x.shape[1]
    order = np.argsort(ids, kind="stable")
    _, first, of = np.unique(x[order].view(np.dtype((np.void, x.itemsize * dim))).ravel(), return_index=True, return_inverse=True)
    rows = order[first]
    members = np.argsort(of, kind="stable")
    count = np.bincount(of, minlength=len(first))
    begin = np.cumsum(count) - count
    scale = (length[rows] / factor[rows]).astype(np.float32)
    spread = (np.sqrt(np.maximum(1 - factor[rows] ** 2, 0)) / np.sqrt(max(dim - 1, 1))).astype(np.float32) * scale
    repeated = len(np.unique(ids)) < len(ids)
    found = ([np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)])
    for a in range(0, len(queries), _CHUNK):
        asked = queries[a : a + _CHUNK]
        product, rounding = estimates(asked @ turn, codes[rows], dim)
        estimate = product * scale + (asked @ centre).astype(np.float32)[:, None]
        error = np.float32(epsilon) * (np.linalg.norm(asked, axis=1).astype(np.float32)[:, None] * spread + rounding[:, None] * scale) + np.float32(1e-5) * np.abs(estimate)
        lower = estimate - error
        m = min(k + 1, lower.shape[1])  # one more, for the query's own row
        least = np.partition(lower, lower.shape[1] - m, axis=1)[:, lower.shape[1] - m]
        for q in range(len(asked)):
            near = np.flatnonzero(estimate[q] + error[q] >= least[q])
            taken = np.minimum(count[near], k + 1)
            flat = np.repeat(begin[near], taken) + np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken)
            own, value = ids[order][members[flat]], np.repeat(scores(x[rows[near]], asked[q]), taken)
            other = own != query_ids[a + q]
            own, value = own[other], value[other]
            if repeated:  # an id with several vectors counts with its best
                best = np.lexsort((-value, own))
                once = best[np.unique(own[best], return_index=True)[1]]
                own, value = own[once], value[once]
            if len(value) > k:  # ties with the k-th stay for the order below
                high = value >= np.partition(value, len(value) - k)[len(value) - k]
                own, value = own[high], value[high]
            best = np.lexsort((own, -value))[:k]
            found[0].append(np.full(len(best), a + q))
            found[1].append(own[best])
            found[2].append(value[best])
    return tuple(np.concatenate(f) for f in found)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, seed: int = 47, epsilon: float = 1.9, block: int = 8192, query_block: int = 16384) -> DataFrame:
    """The ``k`` candidates of ``vectors(vec_id, embedding)`` with the largest inner product for each row of ``queries(vec_id, embedding)``.

    Every usable vector is encoded (see ``index``; the codes' centre is the mean of all vectors, the rotation is drawn from
    ``seed``) into blocks of about ``block`` different rows at most. Queries are dealt into parts of about ``query_block`` at most (fewer, where else too few tasks
    were busy). One task meets one block with one part: both are grouped by block and part, so a block is copied once for each part and a query once for each block, and no
    task gets more than one of each. It gives its ``k`` best by exact score, and a ranking in two steps the best over all.

    Returns ``query_id, rank, vec_id, score``; ties go to the smaller id, and equal vectors have equal scores. Vectors that are null, zero, or hold null or non-finite components take
    no part on either side, nor do those of another dimension than the most frequent one; null ids neither. A query's own
    id is no candidate; rows that repeat an id and a vector count once; an id with several vectors counts with its best score; of a query id with several vectors the smallest vector counts; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    good = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & usable("embedding"))
    sizes = good.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = sizes["dim"] if sizes else 1
    good = good.filter(F.size("embedding") == dim)
    means = good.agg(F.count(F.lit(1)), *(F.avg(F.col("embedding")[i].cast("double")).alias(f"c{i}") for i in range(dim))).first()
    centre, blocks = np.array([m or 0.0 for m in means[1:]]), -(-means[0] // block)
    codes = written(index(good.distinct(), blocks, centre, seed), "codes")
    asked = queries.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & usable("embedding", dim)).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = written(asked, "queries")
    n = asked.count()
    busy = -(-3 * spark.sparkContext.defaultParallelism // max(blocks, 1))
    parts = max(1, -(-n // query_block), min(busy, n // _CHUNK))
    part = F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(parts)).cast("int")
    left = codes.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = asked.withColumn("part", part).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(blocks, 1) - 1))))
    turn = spark.sparkContext.broadcast(rotation(dim, seed))
    kind = np.float64 if "double" in vectors.schema["embedding"].dataType.simpleString() else np.float32
    ship(spark)

    def meet(own: pa.Table, others: pa.Table) -> pa.Table:
        at, near, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if len(own) and len(others):
            query_ids = others.column("vec_id").to_numpy()
            q = others.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            for r in own.select(["ids", "codes", "lengths", "factors", "vectors"]).to_pylist():
                ids, length, factor = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["lengths"]), np.frombuffer(r["factors"])
                code, x = np.frombuffer(r["codes"], np.uint64).reshape(len(ids), -1), np.frombuffer(r["vectors"], kind).reshape(len(ids), dim)
                found = search_block(q, query_ids, centre, turn.value, ids, code, length, factor, x, k, epsilon)
                for all_of, new in zip((at, near, score), (query_ids[found[0]], *found[1:])):
                    all_of.append(new)
        return pa.table([pa.array(np.concatenate(c)) for c in (at, near, score)], ["query_id", "vec_id", "score"])

    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(meet, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
