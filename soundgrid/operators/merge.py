"""Layering overlapping sources into one surface, and roll-ups of it that never lose a shoal."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from soundgrid.functions.depth import DRYING_CAP


def priority_fill(pixels: DataFrame, sources: DataFrame, cell: list[str], small: int = 10_000) -> DataFrame:
    """The first valid value of each cell over sources by priority, then zoom (both descending), then name.

    ``pixels`` has the cell's columns, ``src`` and ``z``; ``sources`` has ``src, priority, maxzoom`` and is broadcast if it has at
    most ``small`` rows. One hash aggregation whose partial results merge, so overlap is reduced before the shuffle. A cell
    without a valid value stays, as NULL.
    """
    ranked = F.broadcast(sources) if sources.limit(small + 1).count() <= small else sources
    order = F.struct((-F.col("priority")).alias("p"), (-F.col("maxzoom")).alias("m"), F.col("src").alias("s"))
    first = F.min(F.when(F.col("z").isNotNull(), F.struct(order.alias("o"), F.col("z").alias("z"))))
    return pixels.join(ranked, "src").groupBy(*cell).agg(first.alias("_f")).select(*cell, F.col("_f.z").alias("z"), F.col("_f.o.s").alias("src"))


def group_ranked(sources: DataFrame) -> DataFrame:
    """The reading order of sources: place of each (priority, zoom, name) group."""
    order = Window.orderBy(F.desc("priority"), F.desc("maxzoom"), "src")
    return sources.withColumn("place", F.dense_rank().over(order))


def shoal_reduce(pixels: DataFrame, levels: int = 1, keys: tuple[str, ...] = ()) -> DataFrame:
    """Halve a grid ``levels`` times: the greatest value at or below the drying cap, or else the greatest.

    The rule gives the same in one step of ``2^levels`` as in single steps, so it is one aggregation.
    """
    r, c = (F.shiftright(F.col(k), levels).alias(k) for k in ("r", "c"))
    low = F.max(F.when(F.col("z") <= DRYING_CAP, F.col("z")))
    return pixels.groupBy(*keys, r, c).agg(F.coalesce(low, F.max("z")).alias("z"))


def shoal_pyramid(pixels: DataFrame, levels: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """All levels in one aggregation: each pixel is given to each level's cell, and partial maxima meet before the shuffle."""
    many = pixels.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    r, c = (F.call_function("shiftright", F.col(k), F.col("level")).alias(k) for k in ("r", "c"))
    low = F.max(F.when(F.col("z") <= DRYING_CAP, F.col("z")))
    return many.groupBy(*keys, "level", r, c).agg(F.coalesce(low, F.max("z")).alias("z"))


def finer_clamp(coarse: DataFrame, fine: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Raise each coarse pixel to the shallowest water of the four finer ones."""
    water = fine.filter("z < 0").groupBy(*keys, F.shiftright("r", 1).alias("r"), F.shiftright("c", 1).alias("c")).agg(F.max("z").alias("_finer"))
    return coarse.join(water, [*keys, "r", "c"], "left").withColumn("z", F.greatest("z", F.when(F.col("z").isNotNull(), F.col("_finer")))).drop("_finer")


def shoalest_cell(pixels: DataFrame, shift: int, least_depth: float = 0.2, keys: tuple[str, ...] = ()) -> DataFrame:
    """The shallowest water of each cell of ``2^shift`` pixels and where it is, first in row order; nothing under the floor."""
    best = F.max(F.struct("z", (-F.col("r")).alias("nr"), (-F.col("c")).alias("nc")))
    cells = pixels.filter("z < 0").groupBy(*keys, F.shiftright("r", shift).alias("cell_r"), F.shiftright("c", shift).alias("cell_c")).agg(best.alias("b"))
    out = cells.select(*keys, "cell_r", "cell_c", (-F.col("b.z")).alias("depth"), (-F.col("b.nr")).alias("r"), (-F.col("b.nc")).alias("c"))
    return out.filter(F.col("depth") >= least_depth)


def sounding_pyramid(soundings: DataFrame, levels: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Each level's shallowest sounding of ``2^level`` cells with its place: one aggregation over all levels."""
    many = soundings.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    r, c = (F.call_function("shiftright", F.col(k), F.col("level")).alias(k) for k in ("cell_r", "cell_c"))
    least = F.min(F.struct("depth", "r", "c"))
    return many.groupBy(*keys, "level", r, c).agg(least.alias("b")).select(*keys, "level", "cell_r", "cell_c", "b.depth", "b.r", "b.c")
