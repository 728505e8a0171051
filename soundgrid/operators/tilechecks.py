"""What is wrong with an archive of vector tiles: features in no tile or below their first zoom, bands that overlap, bands that get lost from a zoom to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundgrid.operators.partition import _part_cuts, coverage_union, overlap_pairs
from soundgrid.operators.polygons import POINTS, convex_parts, polygon_area
from soundgrid.operators.vectors import clip_box
from soundgrid.shipping import written

TILE = ["z", "x", "y"]


def absent_ids(expected: DataFrame, features: DataFrame) -> DataFrame:
    """``layer, id`` of expected features that no tile has."""
    return expected.select("layer", "id").distinct().join(features.select("layer", "id").distinct(), ["layer", "id"], "left_anti")


def too_early(features: DataFrame, first_zoom: Column) -> DataFrame:
    """Features in tiles below the first zoom that they may be in; a null first zoom is any."""
    return features.filter(F.col("z") < first_zoom).select(*TILE, "layer", "id")


def tile_polygons(features: DataFrame, extent: int = 4096) -> DataFrame:
    """``z, x, y, id, ring, holes`` of ring features, cut to their tile without the buffer; whatever turns its rings take, their inside is by the even-odd rule."""
    point = lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y"))
    within = lambda r: F.forall(r, lambda p: p["x"].between(0, extent) & p["y"].between(0, extent))

    def cut(ring: Column) -> Column:
        real = F.transform(ring, point).cast(POINTS)
        return F.when(within(ring), real).otherwise(clip_box(real, 0.0, 0.0, float(extent), float(extent)))

    parts = features.filter(F.col("kind") == 3).select(*TILE, "id", F.filter(F.transform("parts", cut), lambda r: F.size(r) > 2).alias("_parts")).filter(F.size("_parts") > 0)
    return parts.select(*TILE, "id", F.col("_parts")[0].alias("ring"), F.slice("_parts", 2, F.size("_parts")).alias("holes"))


def _cut_up(bands: DataFrame, extent: int) -> tuple[DataFrame, DataFrame]:
    """The bands' polygons and these polygons' boxed convex parts, both worked out once and written."""
    polygons = written(tile_polygons(bands, extent), "polygons")
    return polygons, written(convex_parts(polygons, [*TILE, "id"], boxed=True), "parts")


def overlapping_bands(bands: DataFrame, least_area: float, least_width: float, extent: int = 4096, cut: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``z, x, y, low, high, area`` of bands of one tile that share over ``least_area``, wider than ``least_width``: ribbons that rounding leaves along common edges don't count."""
    polygons, parts = cut or _cut_up(bands, extent)
    found = overlap_pairs(polygons, extent / 8.0, TILE, least_area, parts)
    return found.filter(F.col("width") > least_width).select(*TILE, "low", "high", "area")


def lost_coverage(bands: DataFrame, least_area: float, slack: float, extent: int = 4096, cut: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``z, x, y, lost``: the area of a tile's bands, in its own units, that the bands of its four children don't cover, where all four are there.

    A band of ``slack`` along the rim of all bands together may be lost to rounding; beyond it ``least_area`` may. Where two children's bands lie on each other, what they cover counts once. Children are set into their parent's frame, so all levels are compared in
    one pass over all tiles: a tile meets its children's bands by equality on the parent.
    """
    polygons, parts = cut or _cut_up(bands, extent)
    half = lambda c: F.call_function("shiftright", F.col(c).cast("long"), F.lit(1))
    parent = [(F.col("z") - 1).alias("z"), half("x").alias("x"), half("y").alias("y")]
    whole = written(bands.select(*TILE).distinct().select(*parent).groupBy(*TILE).agg(F.count(F.lit(1)).alias("n")).filter("n = 4").drop("n"), "whole")
    of_whole = lambda d: d.withColumns({c: F.col(c).cast("long") for c in "xy"}).join(whole, TILE, "left_semi")
    parents = of_whole(polygons)
    set_in = lambda c, t: c / 2.0 + (F.col(t) % 2) * (extent / 2.0)
    moved = F.transform("ring", lambda p: F.struct(set_in(p["x"], "x").alias("x"), set_in(p["y"], "y").alias("y"))).cast(POINTS)
    # In two steps, as a name inside a lambda may mean a column of the same select.
    placed = parts.select(*TILE, "id", moved.alias("ring"), *(set_in(F.col(c), c[0]).alias(c) for c in ("x0", "y0", "x1", "y1")))
    children = placed.select(*parent, "id", "ring", "x0", "y0", "x1", "y1").join(whole, TILE, "left_semi")
    cell = extent / 8.0
    common = _part_cuts(of_whole(parts), children, TILE, cell, False).groupBy(*TILE).agg(F.sum("area").alias("common"))
    twice = _part_cuts(children, children, TILE, cell, True).groupBy(*TILE).agg(F.sum("area").alias("twice"))
    sums = coverage_union(parents, TILE).select(*TILE, "rim").join(parents.groupBy(*TILE).agg(F.sum(polygon_area(parents)).alias("area")), TILE)
    met = sums.join(common, TILE, "left").join(twice, TILE, "left").na.fill({"common": 0.0, "twice": 0.0})
    lost = met.withColumn("lost", F.col("area") - F.col("common") + F.col("twice"))
    return lost.filter(F.col("lost") > F.lit(least_area) + F.col("rim") * slack).select(*TILE, "lost")


def selfcheck(features: DataFrame, expected: DataFrame, first_zoom: Column, bands: Column, extent: int = 4096, overlap_area: float = 4.0, overlap_width: float = 3.0, lost_area: float = 4.0, slack: float = 2.0) -> DataFrame:
    """``problem, z, x, y, layer, id, value`` of everything that is wrong with decoded ``features`` (see ``vectortiles.unpacked``); none if all is well.

    ``expected(layer, id)`` must each be in some tile; no feature may be in a tile below ``first_zoom``; the features that ``bands`` names don't overlap within a tile and aren't lost
    from a tile to its children; and there are soundings at all.
    """
    none = lambda kind: F.lit(None).cast(kind)
    rows = lambda df, problem, layer=none("string"), number=none("long"), value=none("double"), tile=True: df.select(F.lit(problem).alias("problem"), *(F.col(c).cast("long").alias(c) if tile else none("long").alias(c) for c in TILE), layer.alias("layer"), number.alias("id"), value.alias("value"))
    own = features.filter(bands)
    cut = _cut_up(own, extent)
    soundings = features.agg(F.count_if(F.col("layer") == "soundings").alias("n")).filter("n = 0")
    found = [
        rows(absent_ids(expected, features), "absent", F.col("layer"), F.col("id"), tile=False),
        rows(too_early(features, first_zoom), "early", F.col("layer"), F.col("id")),
        rows(overlapping_bands(own, overlap_area, overlap_width, extent, cut), "overlap", number=F.col("low"), value=F.col("area")),
        rows(lost_coverage(own, lost_area, slack, extent, cut), "lost", value=F.col("lost")),
        rows(soundings, "no soundings", tile=False),
    ]
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out
