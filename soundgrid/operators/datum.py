"""Vertical reference surfaces: composing them, and filling them where they are missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def geoid_overlay(base: DataFrame, later: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The later grid's row where it is valid, all its values together; else the base's."""
    b = base.select(*keys, F.struct(*values).alias("_b"))
    n = later.filter(F.col(values[0]).isNotNull()).select(*keys, F.struct(*values).alias("_n"))
    both = b.join(n, keys, "full_outer").withColumn("_v", F.coalesce("_n", "_b"))
    return both.select(*keys, *(F.col(f"_v.{v}").alias(v) for v in values))


def region_mosaic(cells: DataFrame, keys: list[str], area: str, value: str) -> DataFrame:
    """Of overlapping regions the smallest one's value; ties to the smaller value."""
    best = F.min(F.when(F.col(value).isNotNull(), F.struct(area, value)))
    return cells.groupBy(*keys).agg(best.alias("_b")).select(*keys, F.col(f"_b.{value}").alias(value))


def separation(frame: Column, surface: Column, low_water: Column, hybrid: Column, geoid: Column, shift: Column) -> Column:
    """Chart datum over the region's frame: surface less low water; in an ellipsoidal frame over the geoids' difference, too; the island frame has low water alone."""
    tidal = surface - low_water
    return F.when(frame == "tidal", tidal).when(frame == "ellipsoid", hybrid + shift - geoid + tidal).when(frame == "island", -low_water)


def corridor_fill(cells: DataFrame, line: DataFrame, reach: float, small: int = 10_000) -> DataFrame:
    """Each cell's value from the nearest point on a gauged line: linear between gauges, nothing beyond ``reach``.

    ``line`` has segments ``x1, y1, v1, x2, y2, v2``: a fixed reference of at most ``small`` rows, checked before it is sent to all tasks.
    """
    if line.limit(small + 1).count() > small:
        raise ValueError(f"a corridor has at most {small} segments")
    segments = line.agg(F.collect_list(F.struct("x1", "y1", "v1", "x2", "y2", "v2")).alias("_s"))

    def near(s: Column) -> Column:
        dx, dy = s["x2"] - s["x1"], s["y2"] - s["y1"]
        length = dx * dx + dy * dy
        t = F.when(length > 0, F.least(F.greatest(((F.col("x") - s["x1"]) * dx + (F.col("y") - s["y1"]) * dy) / length, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
        px, py = s["x1"] + t * dx, s["y1"] + t * dy
        return F.struct(F.sqrt((F.col("x") - px) ** 2 + (F.col("y") - py) ** 2).alias("d"), (s["v1"] + t * (s["v2"] - s["v1"])).alias("v"))

    met = cells.crossJoin(F.broadcast(segments)).withColumn("_n", F.array_min(F.transform("_s", near)))
    return met.drop("_s").withColumn("value", F.when(F.col("_n.d") <= reach, F.col("_n.v"))).drop("_n")


def inside(ring: Column, x: Column, y: Column) -> Column:
    """Whether a ring of points holds a point, by the even-odd rule."""
    n = F.size(ring)
    edges = F.transform(ring, lambda p, i: F.struct(p.alias("a"), F.element_at(ring, F.pmod(i + 1, n) + 1).alias("b")))

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return ((a["y"] > y) != (b["y"] > y)) & (x < a["x"] + (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) * (b["x"] - a["x"]))

    return F.size(F.filter(edges, lambda e: F.coalesce(crosses(e), F.lit(False)))) % 2 == 1


def override(cells: DataFrame, ring: Column, value: Column) -> DataFrame:
    """Cells inside a polygon repainted where the new value is known."""
    return cells.withColumn("value", F.when(inside(ring, F.col("x"), F.col("y")), F.coalesce(value, F.col("value"))).otherwise(F.col("value")))
