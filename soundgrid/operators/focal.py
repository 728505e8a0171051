"""Neighbourhood operators.

Wide neighbourhoods are worked out in blocks with halos that are wide enough for the block's result to be that of the whole raster, so
results have no seams. For narrow ones every pixel is sent to the cells that it touches, and one aggregation combines what arrives.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soundgrid.operators.blocks import Extent, blurred, by_block, nearest_source, reach_of

# Blurs of the shallow and the deep water and of the flat weight, pixels; slopes, degrees, and depths, metres, between which the weights change.
LIGHT, HEAVY, FEATHER = 4.0, 16.0, 4.0
FLAT, STEEP = 1.0, 5.0
SHALLOW, DEEP = 30.0, 200.0


def _taps(offsets: list[tuple[int, int, float]]) -> Column:
    return F.explode(F.array(*(F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc"), F.lit(float(w)).alias("w")) for dr, dc, w in offsets)))


def weighted(pixels: DataFrame, offsets: list[tuple[int, int, float]]) -> DataFrame:
    """Weighted mean of each pixel's valid neighbours; only pixels that are there get one."""
    sent = pixels.filter("z is not null").withColumn("t", _taps(offsets)).select((F.col("r") + F.col("t.dr")).alias("r"), (F.col("c") + F.col("t.dc")).alias("c"), F.col("t.w").alias("w"), (F.col("z") * F.col("t.w")).alias("wz"))
    means = sent.groupBy("r", "c").agg((F.sum("wz") / F.sum("w")).alias("mean"))
    return pixels.join(means, ["r", "c"], "left")


def gaussian(pixels: DataFrame, sigma: float, size: int = 512) -> DataFrame:
    """Gaussian mean of the valid pixels around each pixel, as ``mean``."""

    def mean(z: np.ndarray) -> np.ndarray:
        there = ~np.isnan(z)
        weight = blurred(there.astype(float), sigma)
        return np.where(there, blurred(np.where(there, z, 0.0), sigma) / np.where(there, weight, 1.0), np.nan)

    return by_block(pixels, ["z"], "mean", reach_of(sigma), mean, size=size)


def water_blur(pixels: DataFrame, sigma: float, extent: Extent, size: int = 512) -> DataFrame:
    """Gaussian of the water's depth, as ``mean``: ground and missing pixels are at the datum, and the raster's edge goes on beyond it."""
    blur = lambda z: blurred(np.where(z < 0, z, 0.0), sigma, "edge")
    return by_block(pixels, ["z"], "mean", reach_of(sigma), blur, extent, size)


def slope(pixels: DataFrame, size: float, block: int = 512) -> DataFrame:
    """Degrees of the central gradient; one-sided where a neighbour is missing."""

    def angle(z: np.ndarray) -> np.ndarray:
        def gradient(axis: int) -> np.ndarray:
            line = np.moveaxis(z, axis, 0)
            before, after = np.full_like(line, np.nan), np.full_like(line, np.nan)
            before[1:], after[:-1] = line[:-1], line[1:]
            steps = (~np.isnan(before)).astype(int) + ~np.isnan(after)
            change = np.where(np.isnan(after), line, after) - np.where(np.isnan(before), line, before)
            return np.moveaxis(np.where(steps > 0, change / (np.maximum(steps, 1) * size), 0.0), 0, axis)

        return np.degrees(np.arctan(np.hypot(gradient(0), gradient(1))))

    return by_block(pixels, ["z"], "slope", 1, angle, size=block)


def smooth_shoalward(pixels: DataFrame, pixel: float, extent: Extent, light: float = LIGHT, heavy: float = HEAVY, feather: float = FEATHER, flat: float = FLAT, steep: float = STEEP, shallow: float = SHALLOW, deep: float = DEEP, size: int = 512) -> DataFrame:
    """Water blended towards its blur where it is flat, by the heavy blur the deeper it is, and never made deeper: ``smoothed``.

    In the blurs and the slope, ground and missing pixels are at the datum. The flat weight falls from 1 to 0 between the slopes ``flat`` and ``steep`` and is itself
    blurred; the heavy blur's share grows from 0 to 1 between the depths ``shallow`` and ``deep``. Ground stays as it is.
    """

    def smooth(z: np.ndarray) -> np.ndarray:
        water = z < 0
        work = np.where(water, z, 0.0)
        down, along = (np.gradient(work, pixel, axis=k) if work.shape[k] > 1 else np.zeros_like(work) for k in (0, 1))
        angle = np.degrees(np.arctan(np.hypot(down, along)))
        level = blurred(1 - np.clip((angle - flat) / (steep - flat), 0, 1), feather, "edge")
        share = np.clip((-work - shallow) / (deep - shallow), 0, 1)
        blend = blurred(work, light, "edge") * (1 - share) + blurred(work, heavy, "edge") * share
        return np.where(water, np.maximum(z * (1 - level) + blend * level, z), z)

    return by_block(pixels, ["z"], "smoothed", max(map(reach_of, (light, heavy, feather))) + 1, smooth, extent, size)


def disc(radius: int) -> list[tuple[int, int, float]]:
    """Offsets within a radius and their distances."""
    return [(dr, dc, float(dr * dr + dc * dc) ** 0.5) for dr in range(-radius, radius + 1) for dc in range(-radius, radius + 1) if dr * dr + dc * dc <= radius * radius]


def distance_to(pixels: DataFrame, where: Column, radius: int, size: int = 512) -> DataFrame:
    """Euclidean distance of each pixel to the next pixel with ``where``, within ``radius``; NULL beyond."""

    def distance(there: np.ndarray) -> np.ndarray:
        d2, _ = nearest_source(there == 1, radius)
        return np.where(d2 <= radius * radius, np.sqrt(d2), np.nan)

    marked = pixels.withColumn("_there", F.when(where, 1.0))
    return by_block(marked, ["_there"], "distance", radius, distance, size=size).drop("_there")


def nearest_fill(pixels: DataFrame, radius: int, size: int = 512) -> DataFrame:
    """Missing values from the nearest valid pixel within ``radius``; ties to the first in row order."""

    def fill(z: np.ndarray) -> np.ndarray:
        d2, place = nearest_source(~np.isnan(z), radius)
        return np.where(np.isnan(z), np.where(d2 <= radius * radius, z.ravel()[place], np.nan), z)

    return by_block(pixels, ["z"], "filled", radius, fill, size=size)


def bilinear_sample(points: DataFrame, grid: DataFrame) -> DataFrame:
    """Value of ``grid(r, c, z)`` at ``points(id, x, y)`` from the four pixels around; NULL if one is missing."""
    corners = F.explode(F.array(*(F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr in (0, 1) for dc in (0, 1))))
    fr, fc = F.col("y") - F.floor("y"), F.col("x") - F.floor("x")
    side = lambda f, d: F.when(F.col(d) == 1, f).otherwise(F.lit(1.0) - f)
    taps = points.withColumn("t", corners).select("*", "t.*").select("id", (F.floor("y") + F.col("dr")).cast("int").alias("r"), (F.floor("x") + F.col("dc")).cast("int").alias("c"), (side(fr, "dr") * side(fc, "dc")).alias("w"))
    found = taps.join(grid.select("r", "c", "z"), ["r", "c"], "left").groupBy("id")
    return found.agg(F.when(F.count("z") == 4, F.sum(F.col("w") * F.col("z"))).alias("value"))


def bspline_sample(points: DataFrame, grid: DataFrame, size: int) -> DataFrame:
    """Cubic B-spline value at ``points``: sixteen taps with non-negative weights, clamped at the grid's edge; over what is valid."""
    weights = lambda t: ((1 - t) ** 3 / 6.0, (3 * t**3 - 6 * t**2 + 4) / 6.0, (-3 * t**3 + 3 * t**2 + 3 * t + 1) / 6.0, t**3 / 6.0)
    fr, fc = F.col("y") - F.floor("y"), F.col("x") - F.floor("x")
    wr, wc = (F.array(*weights(f)) for f in (fr, fc))
    spread = points.withColumn("wr", wr).withColumn("wc", wc)
    spread = spread.select("*", F.posexplode("wr").alias("i", "vr")).select("*", F.posexplode("wc").alias("j", "vc"))
    clamp = lambda v: F.least(F.greatest(v, F.lit(0)), F.lit(size - 1)).cast("int")
    taps = spread.select("id", clamp(F.floor("y") + F.col("i") - 1).alias("r"), clamp(F.floor("x") + F.col("j") - 1).alias("c"), (F.col("vr") * F.col("vc")).alias("w"))
    # Sixteen taps a point are far more than the points' file makes Spark expect; by a merge neither side goes through the driver.
    found = taps.hint("merge").join(grid.filter("z is not null").select("r", "c", "z"), ["r", "c"]).groupBy("id")
    return found.agg((F.sum(F.col("w") * F.col("z")) / F.sum("w")).alias("value"))


def crossings(pixels: DataFrame, level: float, stretch: int = 1024) -> DataFrame:
    """How often each row crosses a level between neighbouring valid pixels. A row is cut into stretches; a stretch's last pixel is the one before the next, too."""
    own = F.floor(F.col("c") / stretch)
    cut = pixels.filter("z is not null").withColumn("_of", F.explode(F.when(F.col("c") % stretch == stretch - 1, F.array(own, own + 1)).otherwise(F.array(own))))
    w = Window.partitionBy("r", "_of").orderBy("c")
    crossed = (F.lag("c").over(w) == F.col("c") - 1) & ((F.lag("z").over(w) < level) != (F.col("z") < level))
    return cut.withColumn("cut", F.coalesce(crossed, F.lit(False)).cast("int")).groupBy("r").agg(F.sum("cut").alias("crossings"))


def band_edges(pixels: DataFrame, levels: list[float]) -> DataFrame:
    """The isobath between each two 4-neighbours of different bands: the levels from the shallower to the deeper band, one row each.

    A pixel is sent to its right and lower neighbour's edge, so an edge's two pixels meet in one group.
    """
    from soundgrid.functions.depth import band

    valid = pixels.filter("z is not null").select("r", "c", band(-F.col("z"), levels).alias("b"))
    edges = F.explode(F.array(*(F.struct((F.col("r") + dr).alias("r"), (F.col("c") + dc).alias("c"), F.lit(k).alias("side")) for dr, dc, k in ((0, 0, "h"), (0, 1, "h"), (0, 0, "v"), (1, 0, "v")))))
    met = valid.select("b", edges.alias("e")).groupBy("e.r", "e.c", "e.side").agg(F.count("b").alias("n"), F.min("b").alias("low"), F.max("b").alias("high"))
    cut = met.filter("n = 2 and low < high").select("r", "c", "side", F.explode(F.sequence(F.col("low") + 1, F.col("high"))).alias("k"))
    return cut.select("r", "c", "side", F.element_at(F.array(*(F.lit(v) for v in levels)), F.col("k")).alias("level"))


def seam_feather(pixels: DataFrame, rank: Column, extent: Extent, sigma: float = 2.0, size: int = 512) -> DataFrame:
    """Blend the surface along the inner rims of its sources: ``pixels(r, c, z)`` with ``feathered``. ``rank`` is 1 for the source of the highest priority.

    Layer by layer, the rim of what is covered so far is a seam, unless it is the whole cover's own rim: a pixel whose four neighbours are
    all there and one of them comes from a source of lower priority. The seams' Gaussian over its own peak, as a smooth step, is the share of the surface's
    Gaussian in the blend; missing pixels enter it at the datum. What is at or above the datum never becomes water by it.
    """

    def feather(z: np.ndarray, place: np.ndarray) -> np.ndarray:
        there = ~np.isnan(z)
        own = np.pad(np.where(there, place, np.inf), 1, constant_values=np.inf)
        beside = np.stack([own[:-2, 1:-1], own[2:, 1:-1], own[1:-1, :-2], own[1:-1, 2:]])
        seam = there & np.isfinite(beside).all(axis=0) & (beside.max(axis=0) > own[1:-1, 1:-1])
        filled = np.where(there, z, 0.0)
        t = np.clip(blurred(seam.astype(float), sigma, "symmetric") * np.sqrt(2 * np.pi) * sigma, 0, 1)
        share = t * t * (3 - 2 * t)
        blend = share * blurred(filled, sigma, "symmetric") + (1 - share) * filled
        return np.where((filled >= 0) & (blend < 0), filled, blend)

    ranked = pixels.withColumn("_rank", rank.cast("double"))
    return by_block(ranked, ["z", "_rank"], "feathered", reach_of(sigma) + 1, feather, extent, size).drop("_rank")


def _ring(a: np.ndarray) -> list[np.ndarray]:
    """The eight neighbours of each pixel, around it in order; beyond the array is nothing."""
    n, m = a.shape
    wide = np.pad(a, 1)
    return [wide[1 + i : 1 + i + n, 1 + j : 1 + j + m] for i, j in ((-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1))]


def peeled(cover: np.ndarray, loose: np.ndarray, rounds: int, field: np.ndarray) -> np.ndarray:
    """``cover`` without those ``loose`` pixels that can go while what touches them stays one arc, so no part is cut, lost or pierced.

    ``field`` is 0 to 3 by the parities of row and column; pixels of one field don't touch and go together. Ends when a round takes none.
    """
    cover = cover.copy()
    for _ in range(rounds):
        before = cover.sum()
        for k in range(4):
            ring = _ring(cover)
            arcs = sum((~a & b).astype(np.int8) for a, b in zip(ring, [*ring[1:], ring[0]]))
            cover &= ~(loose & (field == k) & (arcs == 1))
        if cover.sum() == before:
            break
    return cover


def coverage_feather(pixels: DataFrame, cell: float, extent: Extent, size: int = 512) -> DataFrame:
    """Smooth the rim of what a source covers at the scale of its own cells, ``cell`` pixels wide: ``pixels(r, c, z)`` with ``feathered``.

    There is a row for each pixel of ``extent``, ``z`` being null where nothing is covered. The cover's Gaussian of half a cell, from 0.5 on, is
    the wanted cover. It is first added to the cover; then what it hasn't is peeled off by layers, as far as no passage of covered pixels closes or opens by it.
    Added pixels take the nearest covered pixel's value (ties: first in row order), peeled ones have none. A block's halo is as wide as all that can reach it, so no seam shows.
    """
    sigma = cell / 2
    rounds = int(2 * sigma) + 2
    reach = reach_of(sigma)
    halo = reach + 4 * rounds + 2

    def feather(z: np.ndarray, field: np.ndarray) -> np.ndarray:
        valid = ~np.isnan(z)
        if not valid.any() or valid.all():
            return z
        i, j = (int(v[0]) for v in np.nonzero(~np.isnan(field)))
        rows, columns = np.arange(z.shape[0]) - i + int(field[i, j]) // 2, np.arange(z.shape[1]) - j + int(field[i, j]) % 2
        wanted = np.round(blurred(valid.astype(float), sigma, "edge"), 9) >= 0.5
        grown = valid | wanted
        final = peeled(grown, grown & ~wanted, rounds, (rows % 2)[:, None] * 2 + columns % 2)
        _, place = nearest_source(valid, reach + 1)
        return np.where(final, np.where(valid, z, z.ravel()[place]), np.nan)

    marked = pixels.withColumn("_field", (F.pmod("r", F.lit(2)) * 2 + F.pmod("c", F.lit(2))).cast("double"))
    return by_block(marked, ["z", "_field"], "feathered", halo, feather, extent, size).drop("_field")
