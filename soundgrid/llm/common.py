"""Small helpers that several corpus operators share."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundgrid.shipping import discard, mapped, written

#: Bytes that separate words: the blank and the controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def fold(doc_id: Column, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def bounded_sample(df: DataFrame, key: str, limit: int, seed: int) -> DataFrame:
    """About ``limit`` rows of ``df`` at most, chosen by a seeded hash of ``key``; all of them, if they are fewer.

    The share kept is ``limit`` over the number of rows, less three standard deviations, so that the
    bound holds in practice for every seed. The choice doesn't depend on partitioning.
    """
    n = df.count()
    if n <= limit:
        return df
    share = (limit - 3 * limit**0.5) / n
    return df.filter(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 40)) < int(share * (1 << 40)))


def balanced_sample(df: DataFrame, key: str, group: str, limit: int, seed: int) -> DataFrame:
    """About ``limit`` rows of ``df`` at most, by a seeded hash of ``key``, dealt evenly over the values of ``group``: groups below an even share are taken whole, and what they leave goes to the others.

    Groups (languages, say) are few enough to be counted on the driver, and so are rare ones not lost among the rows of frequent ones.
    """
    counts = {r[0]: r[1] for r in df.groupBy(group).count().collect()}
    left, share = limit, 0.0
    for k, n in enumerate(sorted(counts.values())):
        share = max(share, left / (len(counts) - k))
        left -= min(n, left / (len(counts) - k))
    if sum(counts.values()) <= limit:
        return df
    parts = [(g, 1.0 if n <= share else max(share - 3 * share**0.5, 1.0) / n) for g, n in counts.items()]
    shares = df.sparkSession.createDataFrame(parts, df.select(F.col(group).alias("_group"), F.lit(1.0).alias("_share")).schema)
    chosen = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 40)) < F.col("_share") * float(1 << 40)
    return df.join(F.broadcast(shares), F.col(group).eqNullSafe(F.col("_group"))).filter(chosen).drop("_group", "_share")


def bounded_texts(rows: DataFrame, key: str, text: str, limit: int, seed: int) -> DataFrame:
    """The rows of a bounded sample, written, with at most ``limit`` bytes of ``text`` in all.

    Where the sample is larger than the bound, rows come in the order of a seeded hash of the key, and one that
    doesn't fit in what is left of the bound is passed over, so one very long text can't fill a machine.
    """
    rows = written(rows, "sample")
    sizes = rows.select(key, F.octet_length(text).alias("n"), F.xxhash64(F.lit(seed), F.col(key)).alias("h")).collect()
    left, kept = limit, set()
    for r in sorted(sizes, key=lambda r: (r["h"], r[key])):
        if r["n"] <= left:
            kept.add(r[key])
            left -= r["n"]
    if len(kept) == len(sizes):
        return rows
    ids = rows.sparkSession.createDataFrame([(k,) for k in sorted(kept)], rows.select(key).schema)
    fitting = written(rows.join(F.broadcast(ids), key), "sample")
    discard(rows)
    return fitting


def collected_texts(rows: DataFrame, key: str, text: str, limit: int, seed: int) -> list:
    """The rows of ``bounded_texts`` by ``key`` in order, on the driver."""
    rows = bounded_texts(rows, key, text, limit, seed)
    found = sorted(rows.collect(), key=lambda r: r[key])
    discard(rows)
    return found


def fitted(rows: DataFrame, key: str, fit: Callable[[list[dict]], object]) -> object:
    """What ``fit`` makes of the rows of a bounded table by ``key`` in order, worked out in one task, so that the driver gets the model and never the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sorted((r for batch in batches for r in batch.to_pylist()), key=lambda r: r[key])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(own))], pa.binary())], ["model"])

    found = mapped(rows.coalesce(1), run, "model binary").collect()
    return pickle.loads(found[0][0]) if found else fit([])


def prefix_offsets(df: DataFrame, order: str, amounts: list[str], within: list[str] = (), group: int = 4096) -> DataFrame:
    """Add to each row the sums of ``amounts`` over the rows before it, as ``<amount>_before``.

    ``order`` is a unique non-negative integer in each ``within`` group. The sums are taken in two steps,
    inside ranges of ``group`` consecutive positions and over the ranges, so no task sees all rows.
    """
    from pyspark.sql import Window

    ranged = df.withColumn("_range", F.floor(F.col(order) / group))
    inner = Window.partitionBy(*within, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*within, "_range").agg(*(F.sum(a).alias(f"_sum_{a}") for a in amounts))
    totals = totals.select(*within, "_range", *(F.coalesce(F.sum(f"_sum_{a}").over(outer), F.lit(0)).alias(f"_off_{a}") for a in amounts))
    ranged = ranged.withColumns({f"{a}_before": F.coalesce(F.sum(a).over(inner), F.lit(0)) for a in amounts})
    same = F.lit(True)
    left, right = ranged.alias("l"), totals.alias("r")
    for c in [*within, "_range"]:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    joined = left.join(right, same).select("l.*", *(f"r._off_{a}" for a in amounts))
    return joined.withColumns({f"{a}_before": F.col(f"{a}_before") + F.col(f"_off_{a}") for a in amounts}).drop("_range", *(f"_off_{a}" for a in amounts))
