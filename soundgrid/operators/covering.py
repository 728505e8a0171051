"""Which files cover which tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soundgrid.functions.tiles import HALF_WORLD, MACROTILE_Z, OVERVIEWS


def _cell(v: Column, zoom: int, flip: bool) -> Column:
    side = 2 * HALF_WORLD / 2**zoom
    at = (F.lit(HALF_WORLD) - v) / side if flip else (v + HALF_WORLD) / side
    return F.least(F.greatest(F.floor(at).cast("int"), F.lit(0)), F.lit(2**zoom - 1))


def split_antimeridian(files: DataFrame) -> DataFrame:
    """Bounds whose left is over their right cross the antimeridian: two rows, one on each side."""
    wraps = F.col("left") > F.col("right")
    parts = F.when(wraps, F.array(F.struct("left", F.lit(HALF_WORLD).alias("right")), F.struct(F.lit(-HALF_WORLD).alias("left"), "right"))).otherwise(F.array(F.struct("left", "right")))
    return files.withColumn("_p", F.explode(parts)).withColumn("left", F.col("_p.left")).withColumn("right", F.col("_p.right")).drop("_p")


def cells_of(files: DataFrame, zoom: int, buffer: float = 0.0) -> DataFrame:
    """A row for each tile of ``zoom`` that a file's buffered bounds reach: ``cell_x, cell_y``. The bins of overlap joins."""
    parts = split_antimeridian(files)
    xs = F.explode(F.sequence(_cell(F.col("left") - buffer, zoom, False), _cell(F.col("right") + buffer, zoom, False)))
    ys = F.explode(F.sequence(_cell(F.col("top") + buffer, zoom, True), _cell(F.col("bottom") - buffer, zoom, True)))
    return parts.withColumn("cell_x", xs).withColumn("cell_y", ys)


def bbox_overlap_join(files: DataFrame, tiles: DataFrame, zoom: int = MACROTILE_Z) -> DataFrame:
    """``filename, x, y`` of the files whose bounds overlap (not just touch) the tiles of one zoom: an equality join on bins (a metre wider than the bounds, against rounding), then the exact test."""
    side = 2 * HALF_WORLD / 2**zoom
    left, top = F.col("x") * side - HALF_WORLD, F.lit(HALF_WORLD) - F.col("y") * side
    binned = cells_of(files, zoom, buffer=1.0).withColumnsRenamed({"cell_x": "x", "cell_y": "y"})
    met = binned.join(tiles.select("x", "y"), ["x", "y"])
    return met.filter((F.col("left") < left + side) & (F.col("right") > left) & (F.col("bottom") < top) & (F.col("top") > top - side)).select("filename", "x", "y").distinct()


def group_ids(items: DataFrame) -> DataFrame:
    """For each macrotile of ``items(x, y, source, maxzoom)`` the sorted set of its sources and zooms, as one text."""
    return items.groupBy("x", "y").agg(F.array_join(F.sort_array(F.collect_set(F.concat_ws(":", "source", "maxzoom"))), ",").alias("group_id"), F.max("maxzoom").alias("maxzoom"))


def aggregation_tiles(groups: DataFrame) -> DataFrame:
    """The coarsest tiles that hold one group each and aren't over ``OVERVIEWS`` zooms above its data: ``z, x, y``.

    One aggregation tells of every ancestor of every macrotile, up to the seed zoom, whether it may stop the descent. Those that may
    are intervals of a quadtree order below their seed tile, 341 at most of each; the ones that no earlier one holds are the tiles.
    """
    seed = MACROTILE_Z - OVERVIEWS
    above = groups.withColumn("z", F.explode(F.sequence(F.lit(seed), F.lit(MACROTILE_Z))))
    up = F.lit(MACROTILE_Z) - F.col("z")
    shifted = lambda c, by: F.call_function("shiftright", F.col(c), by)
    tiles = above.groupBy("z", shifted("x", up).alias("tx"), shifted("y", up).alias("ty")).agg(F.min("group_id").alias("a"), F.max("group_id").alias("b"), F.max("maxzoom").alias("m"))
    stop = tiles.filter((F.col("z") == MACROTILE_Z) | ((F.col("a") == F.col("b")) & (F.col("z") >= F.col("m") - OVERVIEWS))).select("z", F.col("tx").alias("x"), F.col("ty").alias("y"))
    first = lambda c: F.call_function("shiftleft", F.col(c), up)
    bits = (F.call_function("shiftleft", F.shiftright(first(c), i).bitwiseAND(1), F.lit(2 * i + k)) for k, c in enumerate("xy") for i in range(OVERVIEWS))
    start = sum(bits, F.lit(0))
    placed = stop.withColumn("start", start).withColumn("end", F.col("start") + F.call_function("shiftleft", F.lit(1), up * 2))
    before = Window.partitionBy(shifted("x", F.col("z") - seed), shifted("y", F.col("z") - seed)).orderBy("start", "z").rowsBetween(Window.unboundedPreceding, -1)
    held = F.coalesce(F.max("end").over(before) > F.col("start"), F.lit(False))
    return placed.withColumn("held", held).filter("not held").select("z", "x", "y")


def finer_index(stems: DataFrame) -> DataFrame:
    """``coarse, fine``: stems whose data are one zoom apart and of whose tiles one holds the other. Ancestors are exploded and joined by equality."""
    up = stems.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("z"))))
    shifted = lambda c: F.call_function("shiftright", F.col(c), F.col("_k")).alias(c)
    holders = up.select(F.col("stem").alias("own"), F.col("child_z").alias("own_z"), (F.col("z") - F.col("_k")).alias("z"), shifted("x"), shifted("y"))
    met = holders.join(stems, ["z", "x", "y"])
    below = met.filter(F.col("own_z") == F.col("child_z") + 1).select(F.col("stem").alias("coarse"), F.col("own").alias("fine"))
    above = met.filter(F.col("child_z") == F.col("own_z") + 1).select(F.col("own").alias("coarse"), F.col("stem").alias("fine"))
    return below.unionByName(above).distinct()


def bbox_union(files: DataFrame) -> DataFrame:
    """Longitudes and latitudes of all bounds of a source; over the antimeridian the union is taken on the circle, and a full one is the planet."""
    west, east = F.col("left") / HALF_WORLD * 180.0, F.col("right") / HALF_WORLD * 180.0
    lat = lambda y: F.degrees(F.lit(2.0) * F.atan(F.exp(y / HALF_WORLD * F.pi())) - F.pi() / 2.0)
    span = F.pmod(east - west, F.lit(360.0))
    span = F.when((span == 0) & (east > west), 360.0).otherwise(span)
    start = F.pmod(west, F.lit(360.0))
    agg = files.groupBy("source").agg(F.min(west).alias("w"), F.max(east).alias("e"), F.min("bottom").alias("b"), F.max("top").alias("t"), F.max((west > east).cast("int")).alias("wraps"), F.min(start).alias("w360"), F.max(start + span).alias("e360"), F.count(F.lit(1)).alias("files"))
    turn = lambda v: F.pmod(v + 180.0, F.lit(360.0)) - 180.0
    full = F.col("e360") - F.col("w360") >= 360.0
    pick = lambda plain, around, planet: F.when(F.col("wraps") == 0, plain).when(full, planet).otherwise(around)
    return agg.select("source", F.round(pick(F.col("w"), turn(F.col("w360")), F.lit(-180.0)), 6).alias("west"), F.round(lat(F.col("b")), 6).alias("south"), F.round(pick(F.col("e"), turn(F.col("e360")), F.lit(180.0)), 6).alias("east"), F.round(lat(F.col("t")), 6).alias("north"), "files")


def deepest_ancestor(requests: DataFrame, tiles: DataFrame, keep: list[str]) -> DataFrame:
    """For each tile asked for the deepest existing tile that holds it (itself included), with ``keep`` of it; NULL if none."""
    up = requests.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("z"))))
    shifted = lambda c: F.call_function("shiftright", F.col(c), F.col("_k")).alias(f"a{c}")
    asked = up.select("z", "x", "y", (F.col("z") - F.col("_k")).alias("az"), shifted("x"), shifted("y"))
    there = tiles.select(F.col("z").alias("az"), F.col("x").alias("ax"), F.col("y").alias("ay"), *keep)
    found = asked.join(there, ["az", "ax", "ay"]).groupBy("z", "x", "y").agg(F.max(F.struct("az", *keep)).alias("b"))
    return requests.join(found, ["z", "x", "y"], "left").select("z", "x", "y", F.col("b.az").alias("found_z"), *(F.col(f"b.{k}").alias(k) for k in keep))


def macrotile_map(files: DataFrame, buffer: float = 300.0) -> DataFrame:
    """For each macrotile and source the sorted files and zooms whose widened bounds reach it."""
    cells = cells_of(files, MACROTILE_Z, buffer).distinct()
    return cells.groupBy(F.col("cell_x").alias("x"), F.col("cell_y").alias("y"), "source").agg(F.sort_array(F.collect_set(F.concat_ws(":", "filename", "maxzoom"))).alias("files"))


def render_stems(stems: DataFrame) -> DataFrame:
    """The pyramid over native stems: every stem's parents, data zoom by data zoom down to 0, as ``z, x, y, child_z``.

    A stem of data zoom ``k`` hands data zoom ``k - 1`` its own tile, or that tile's parent once the tile is as large as a render tile may be. As this
    only depends on the stem, all levels come from one explosion.
    """
    up = stems.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("child_z"))))
    z = F.greatest(F.least(F.col("z"), F.col("child_z") - F.col("_k")), F.lit(0))
    shift = F.col("z") - z
    moved = lambda c: F.call_function("shiftright", F.col(c), shift).alias(c)
    return up.select(z.alias("z"), moved("x"), moved("y"), (F.col("child_z") - F.col("_k")).alias("child_z")).distinct()
