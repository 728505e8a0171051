"""Features with geometry as arrays of points: measures, clipping masks, rings, shared edges. Expressions over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _pairs(ring: Column) -> Column:
    """Each point of a ring with the one after it, the last with the first.

    The names are given as values: in a select with an ``explode``, Spark drops aliases in a nested lambda before it has read them.
    """
    n = F.size(ring)
    return F.transform(ring, lambda p, i: F.named_struct(F.lit("a"), p, F.lit("b"), F.element_at(ring, F.pmod(i + 1, n) + 1)))


def ring_area(ring: Column) -> Column:
    """Shoelace area of a ring of ``struct<x, y>``, from its first point: far from the origin a small ring's area isn't lost in its coordinates' products."""

    def shoelace(r: Column) -> Column:
        first = F.get(r, F.lit(0))
        x, y = (lambda p: p["x"] - first["x"]), (lambda p: p["y"] - first["y"])
        return F.abs(F.aggregate(_pairs(r), F.lit(0.0), lambda s, e: s + x(e["a"]) * y(e["b"]) - x(e["b"]) * y(e["a"]))) / 2.0

    return _once(ring, shoelace)


def ring_length(ring: Column) -> Column:
    step = lambda s, e: s + F.sqrt((e["b"]["x"] - e["a"]["x"]) ** 2 + (e["b"]["y"] - e["a"]["y"]) ** 2)
    return F.aggregate(_pairs(ring), F.lit(0.0), step)


def vector_metrics(features: DataFrame, keys: list[str], small: float) -> DataFrame:
    """Parts, vertices and the share of parts under an area."""
    measured = features.withColumn("_a", ring_area(F.col("ring")))
    return measured.groupBy(*keys).agg(F.count(F.lit(1)).alias("parts"), F.sum(F.size("ring")).alias("vertices"), (F.count(F.when(F.col("_a") < small, 1)) / F.count(F.lit(1))).alias("small_share"))


def deep_ring_drop(features: DataFrame, deep: float = 1000.0, least_area: float = 16e6) -> DataFrame:
    """Closed rings of deep levels stay only if they are large."""
    return features.filter((F.col("level") < deep) | (ring_area(F.col("ring")) >= least_area))


def legible(area: Column, length: Column, least_area: float, least_width: float, drying: Column) -> Column:
    """Slivers go by area; drying ground only if it is both small and narrow (twice the area over the rim)."""
    narrow = area * 2.0 / F.when(length > 0, length) < least_width
    return F.when(drying, ~((area < least_area) & F.coalesce(narrow, F.lit(True)))).otherwise(area >= least_area)


def shared_edges(features: DataFrame) -> DataFrame:
    """Segments that exactly two features own, one row each: ``ax, ay, bx, by, low, high`` (both features' numbers in order).

    A segment's ends are put in order, so both owners group on the same key: one aggregation finds all neighbours.
    """
    segments = features.select("id", F.explode(_pairs(F.col("ring"))).alias("e")).select("id", F.least("e.a", "e.b").alias("p"), F.greatest("e.a", "e.b").alias("q"))
    owned = segments.distinct().groupBy("p", "q").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    return owned.filter("n = 2").select(F.col("p.x").alias("ax"), F.col("p.y").alias("ay"), F.col("q.x").alias("bx"), F.col("q.y").alias("by"), "low", "high")


def rasterize(features: DataFrame, height: int) -> DataFrame:
    """Pixels whose centre is in a feature's rings by the even-odd rule: ``id, r, c``, with ``c`` from crossing to crossing.

    Each edge meets the rows that it crosses; a row's crossings in order, taken two by two, are the spans inside.
    """
    from pyspark.sql import Window

    edges = features.select("id", F.explode(_pairs(F.col("ring"))).alias("e")).select("id", "e.a.x", "e.a.y", F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2")).filter("y <> y2")
    low, high = F.least("y", "y2"), F.greatest("y", "y2")
    first, last = F.greatest(F.ceil(low - 0.5), F.lit(0)), F.least(F.ceil(high - 0.5) - 1, F.lit(height - 1))
    cut = edges.withColumn("first", first).withColumn("last", last).filter("first <= last").withColumn("r", F.explode(F.sequence("first", "last")))
    at = cut.select("id", "r", (F.col("x") + (F.col("r") + 0.5 - F.col("y")) / (F.col("y2") - F.col("y")) * (F.col("x2") - F.col("x"))).alias("x"))
    w = Window.partitionBy("id", "r").orderBy("x")
    spans = at.withColumn("k", F.row_number().over(w)).withColumn("x2", F.lead("x").over(w)).filter("k % 2 = 1 and x2 is not null")
    start, stop = F.ceil(F.col("x") - 0.5), F.ceil(F.col("x2") - 0.5) - 1
    return spans.withColumn("start", start).withColumn("stop", stop).filter("start <= stop").select("id", F.col("r").cast("int").alias("r"), F.explode(F.sequence(F.col("start").cast("int"), F.col("stop").cast("int"))).alias("c"))


def seam_adjacency(tiles: DataFrame) -> DataFrame:
    """Pairs of tiles that share part of an edge: ``stem, other, side``. Right edges meet left ones, and the planet's ends meet, too.

    Edges are whole numbers on the finest grid. Of two tiles on both sides of an edge the finer one's row (or column), taken up to the coarser one's zoom, is that one's own: so
    they meet by equality on the edge, the zoom and the row, and no key has more than an edge's few tiles, however many lie along the same meridian.
    """
    scale = lambda v, extra=0: F.call_function("shiftleft", (F.col(v) + extra).cast("long"), F.lit(20) - F.col("z"))

    def across(along: str, over: str, side: str, wraps: bool) -> DataFrame:
        far = F.pmod(scale(over, 1), F.lit(1 << 20)) if wraps else scale(over, 1)
        first, second = tiles.select("stem", "z", far.alias("edge"), F.col(along).alias("row")), tiles.select(F.col("stem").alias("other"), "z", scale(over).alias("edge"), F.col(along).alias("row"))
        up = lambda d, least: d.withColumn("up", F.explode(F.when(F.col("z") >= least, F.sequence(F.lit(least), F.col("z").cast("int"))).otherwise(F.array().cast("array<int>"))))
        above = lambda d, least, name: up(d, least).select(name, "edge", (F.col("z") - F.col("up")).alias("z"), F.call_function("shiftright", F.col("row").cast("long"), F.col("up")).alias("row"))
        own = lambda d, name: d.select(name, "edge", "z", F.col("row").cast("long").alias("row"))
        key = ["edge", "z", "row"]
        finer_second = own(first, "stem").join(above(second, 0, "other"), key)
        finer_first = above(first, 1, "stem").join(own(second, "other"), key)
        return finer_second.unionByName(finer_first).select("stem", "other", F.lit(side).alias("side"))

    return across("y", "x", "east", True).unionByName(across("x", "y", "south", False))


def clip_box(ring: Column, left: float, bottom: float, right: float, top: float) -> Column:
    """A ring cut to a box, side by side: points inside stay, and edges that cross a side get a point on it. Empty if nothing is left.

    One fold over the four sides, whose state is the ring as cut so far, so no side's work is done twice.
    """
    kind = "array<struct<x: double, y: double>>"
    none = F.array().cast(kind)
    sides = F.array(*(F.struct(F.lit(on_x).alias("on_x"), F.lit(float(limit)).alias("limit"), F.lit(sign).alias("sign")) for on_x, limit, sign in ((True, left, 1.0), (True, right, -1.0), (False, bottom, 1.0), (False, top, -1.0))))

    def cut(points: Column, side: Column) -> Column:
        at = lambda p: F.when(side["on_x"], p["x"]).otherwise(p["y"])
        is_in = lambda p: (at(p) - side["limit"]) * side["sign"] >= 0

        def edge(e: Column) -> Column:
            a, b = e["a"], e["b"]
            t = (side["limit"] - at(a)) / F.nullif(at(b) - at(a), F.lit(0.0))
            x = F.when(side["on_x"], side["limit"]).otherwise(a["x"] + t * (b["x"] - a["x"]))
            y = F.when(side["on_x"], a["y"] + t * (b["y"] - a["y"])).otherwise(side["limit"])
            crossing = F.when(is_in(a) != is_in(b), F.array(F.struct(x.alias("x"), y.alias("y"))).cast(kind)).otherwise(none)
            return F.concat(crossing, F.when(is_in(b), F.array(b).cast(kind)).otherwise(none))

        return F.flatten(F.transform(_pairs(points), edge)).cast(kind)

    return F.aggregate(sides, ring.cast(kind), cut)


def snapped(ring: Column, digits: int = 9) -> Column:
    """Points on a decimal grid, without ones that repeat the point before."""
    at = F.transform(ring, lambda p: F.struct(F.round(p["x"], digits).alias("x"), F.round(p["y"], digits).alias("y")))

    def apart(at: Column) -> Column:
        n = F.size(at)
        return F.filter(at, lambda p, i: (n == 1) | (p != F.element_at(at, F.pmod(i - 1 + n, n) + 1)))

    return _once(at, apart)


def snapped_within(features: DataFrame, digits: int, most: float, share: float) -> DataFrame:
    """``features`` with rings on a decimal grid, the area that this ``lost``, and what is wrong: a ring ``eaten`` up, by over ``most`` and over a ``share`` of its area at once (either alone is wrong at some scale), or ``collapsed`` without that."""
    told = features.withColumn("_was", ring_area(F.col("ring"))).withColumn("ring", snapped(F.col("ring"), digits))
    told = told.withColumn("lost", F.col("_was") - ring_area(F.col("ring")))
    problem = F.when((F.col("lost") > most) & (F.col("lost") > F.col("_was") * share), "eaten").when(F.size("ring") < 3, "collapsed")
    return told.withColumn("problem", problem).drop("_was")


def feature_tiles(features: DataFrame, maxzoom: int, keep: list[str] | None = None) -> DataFrame:
    """The tiles in which each feature is drawn: from its ``minzoom`` on (to its ``lastzoom``, if it has one), those that its box meets; positions in units of the world. ``keep`` names columns to pass on."""
    last = F.least(F.coalesce("lastzoom", F.lit(maxzoom)), F.lit(maxzoom))
    many = features.withColumn("z", F.explode(F.sequence(F.col("minzoom"), F.greatest(last, F.col("minzoom"))))).filter(F.col("z") <= last)
    side = F.pow(F.lit(2.0), F.col("z").cast("double"))
    cell = lambda v: F.least(F.greatest(F.floor(F.col(v) * side), F.lit(0)), side.cast("long") - 1).cast("int")
    return many.withColumn("x", F.explode(F.sequence(cell("x0"), cell("x1")))).withColumn("y", F.explode(F.sequence(cell("y0"), cell("y1")))).select("id", "z", "x", "y", *(keep or []))


def chains(segments: DataFrame) -> DataFrame:
    """Segments that continue each other get one chain's number: ``segments(id, ax, ay, bx, by)`` with ``chain``, the least number in it.

    Two segments continue each other where they alone end at a point; forks end chains.
    """
    from soundgrid.operators.graph import components

    ends = segments.select("id", F.explode(F.array(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")))).alias("p"))
    met = ends.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).filter("n = 2 and a < b")
    labels = components(met.select("a", "b"))
    return segments.join(labels.select(F.col("node").alias("id"), "label"), "id", "left").withColumn("chain", F.coalesce("label", "id")).drop("label")


def clip_segments(segments: DataFrame, left: float, bottom: float, right: float, top: float) -> DataFrame:
    """The parts of ``segments(id, ax, ay, bx, by)`` inside a box: the range of the parameter that satisfies all four sides."""
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    enter, leave, out = F.lit(0.0), F.lit(1.0), F.lit(False)
    for d, room in ((-dx, F.col("ax") - left), (dx, F.lit(right) - F.col("ax")), (-dy, F.col("ay") - bottom), (dy, F.lit(top) - F.col("ay"))):
        t = room / F.nullif(d, F.lit(0.0))
        enter = F.when(d < 0, F.greatest(enter, t)).otherwise(enter)
        leave = F.when(d > 0, F.least(leave, t)).otherwise(leave)
        out = out | ((d == 0) & (room < 0))
    cut = segments.withColumn("_t0", enter).withColumn("_t1", leave).filter(~out & (F.col("_t0") <= F.col("_t1")))
    at = lambda a, d, t: (F.col(a) + F.col(t) * d)
    return cut.select("id", at("ax", dx, "_t0").alias("ax"), at("ay", dy, "_t0").alias("ay"), at("ax", dx, "_t1").alias("bx"), at("ay", dy, "_t1").alias("by"))
