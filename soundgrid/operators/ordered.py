"""Order-dependent rules, one key's rows at a time: each key is a tile, a seam or a source, so its rows are few by construction.

Spark groups and ships the rows; a small function walks one key's rows in order.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction
from math import inf

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from soundgrid.shipping import mapped, ship


def match_sorted(a: DataFrame, b: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """Pair two sorted lists of positions of each key greedily within a tolerance: ``keys, pa, pb``; either is NULL where nothing matches."""
    ship(a.sparkSession)

    def walk(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        x, y, out, i, j = sorted(left["p"]), sorted(right["p"]), [], 0, 0
        while i < len(x) or j < len(y):
            if i < len(x) and j < len(y) and abs(x[i] - y[j]) <= tolerance:
                out.append((*key, x[i], y[j]))
                i, j = i + 1, j + 1
            elif j >= len(y) or i < len(x) and x[i] < y[j]:
                out.append((*key, x[i], None))
                i += 1
            else:
                out.append((*key, None, y[j]))
                j += 1
        return pd.DataFrame(out, columns=[*keys, "pa", "pb"]).astype({"pa": "float64", "pb": "float64"})

    schema = ", ".join([*(f"{k} {a.schema[k].dataType.simpleString()}" for k in keys), "pa double, pb double"])
    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(walk, schema)


def plan_batches(groups: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Orders of whole groups under a byte limit, filled in the groups' sequence: ``keys, name, size, batch``. A larger group is an order of its own."""
    ship(groups.sparkSession)

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("name", kind="stable")
        batch, used, out = 0, 0, []
        for size in rows["size"]:
            if used and used + size > limit:
                batch, used = batch + 1, 0
            used += size
            out.append(batch)
        return rows.assign(batch=pd.array(out, dtype="int32"))[[*keys, "name", "size", "batch"]]

    schema = ", ".join([*(f"{c} {groups.schema[c].dataType.simpleString()}" for c in [*keys, "name", "size"]), "batch int"])
    return groups.groupBy(*keys).applyInPandas(walk, schema)


def _heavies_before(j: int, d: Fraction, a: Fraction, b: Fraction) -> float:
    """Heavy tiles placed before the light one number ``j``: as few as bring the sum above the line."""
    if d > j * b:
        return 0
    return (j * b - d) // a + 1 if a > 0 else inf


def _lights_before(k: int, d: Fraction, a: Fraction, b: Fraction) -> int:
    """Light tiles placed before the heavy one number ``k``: as few as bring the sum down to the line."""
    return max(0, -((-d) // b), -((-d - k * a) // b)) if b > 0 else 0


def _phases(classes: list[tuple]) -> dict:
    """Pieces of each weight's ranks, ``(first rank, ranks, heavy, places before, sum over the line, a, b)``, from ``(weight, tiles)``, heaviest first.

    While one weight is the heaviest and one the lightest, a heavy tile lifts the sum by ``a`` over the line and a light one lowers it by ``b``.
    """
    weights, left = [Fraction(w) for w, _ in classes], [c for _, c in classes]
    average = sum(w * c for w, c in zip(weights, left)) / max(sum(left), 1)
    first, out = [0] * len(left), defaultdict(list)
    p, q, place, d = 0, len(left) - 1, 0, Fraction(0)
    while p <= q:
        a, b = weights[p] - average, average - weights[q]
        if p == q:  # the rest is all of one weight and goes from one end
            heavies, lights = (left[p], 0) if d <= 0 else (0, left[p])
        else:
            last_heavy = left[p] - 1 + _lights_before(left[p] - 1, d, a, b)
            last_light = left[q] - 1 + _heavies_before(left[q] - 1, d, a, b)
            heavies, lights = (left[p], last_heavy + 1 - left[p]) if last_heavy < last_light else (last_light + 1 - left[q], left[q])
        heavies, lights = int(heavies), int(lights)
        if heavies:
            out[classes[p][0]].append((first[p], heavies, True, place, d, a, b))
            first[p] += heavies
            left[p] -= heavies
        if lights:
            left[q] -= lights
            out[classes[q][0]].append((first[q] + left[q], lights, False, place, d, a, b))
        place, d = place + heavies + lights, d + heavies * a - lights * b
        p += left[p] == 0
        q -= q >= p and left[q] == 0
    return {w: sorted(pieces) for w, pieces in out.items()}


#: Different weights over which the driver may walk.
MOST_WEIGHTS = 100_000


def tile_priority(tiles: DataFrame, ranks: int = 4096) -> DataFrame:
    """An order of ``tiles(stem, weight)`` whose cumulative weight keeps to the average line.

    The next tile is the heaviest left while the weight so far is at most the number of tiles so far times the average, else the
    lightest left; ties by a hash of the name. The driver walks over the different weights, ``MOST_WEIGHTS`` at most (more are an error), not over the tiles: where a weight
    is at an end, its ranks' places have a closed form. Ranks are counted in ranges of the hash of about ``ranks`` tiles. A tile without weight has no place.
    """
    classes = [(r[0], r[1]) for r in tiles.filter("weight is not null").groupBy("weight").count().limit(MOST_WEIGHTS + 1).collect()]
    if len(classes) > MOST_WEIGHTS:
        raise ValueError(f"over {MOST_WEIGHTS} different weights: round them, as to two digits")
    known = _phases(sorted(classes, reverse=True))
    tied = tiles.select("stem", "weight", F.xxhash64("stem").alias("_tie"))
    ranges = max(1, -(-sum(c for _, c in classes) // ranks))
    tied = tied.withColumn("_range", F.floor((F.shiftright("_tie", 32) + F.lit(1 << 31)) * F.lit(ranges) / F.lit(1 << 32)))
    counts = tied.groupBy("weight", "_range").count()
    before = F.sum("count").over(Window.partitionBy("weight").orderBy("_range")) - F.col("count")
    counts = counts.select(F.col("weight").alias("_w"), F.col("_range").alias("_r"), before.alias("_before"))
    ranked = tied.join(counts, F.col("weight").eqNullSafe(F.col("_w")) & (F.col("_range") == F.col("_r")))
    inside = F.row_number().over(Window.partitionBy("weight", "_range").orderBy("_tie", "stem"))
    ranked = ranked.select("stem", "weight", (inside - 1 + F.col("_before")).alias("_rank"))

    def place(weight, rank: int) -> int | None:
        if weight is None:
            return None
        pieces = known[weight]
        start, n, heavy, done, d, a, b = pieces[bisect_right(pieces, rank, key=lambda x: x[0]) - 1]
        k = rank - start if heavy else start + n - 1 - rank
        if a + b == 0:  # the last weight, alone
            return done + k + 1
        return int(done + k + 1 + (_lights_before(k, d, a, b) if heavy else _heavies_before(k, d, a, b)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [place(w, r) for w, r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places, pa.int32())], ["stem", "weight", "place"])

    kinds = [f"{c} {tiles.schema[c].dataType.simpleString()}" for c in ("stem", "weight")]
    return mapped(ranked, run, ", ".join([*kinds, "place int"]))

