"""Partitions into polygons: overlaps, dissolved boundaries and what a change of boundaries may trade. Features have an ``id`` and a ``ring`` of points.

Features meet by equality on the square bins that their boxes cover, and a pair is kept in one bin only: the one that holds
the lower left corner of what their boxes share. Cuts are made on the convex parts of rings of any simple form, with holes (see ``polygons``).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundgrid.operators.graph import components
from soundgrid.operators.intervals import interval_union
from soundgrid.operators.polygons import POINTS, convex_parts, corners_of, holes_of, polygon_area, polygon_rim, shared_areas
from soundgrid.operators.vectors import _once, _pairs, ring_area
from soundgrid.shipping import mapped, written


def signed_area(ring: Column) -> Column:
    """Positive where a ring runs anticlockwise."""
    return F.aggregate(_pairs(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]) / 2.0


def _anticlockwise(ring: Column) -> Column:
    return F.when(signed_area(ring) < 0, F.reverse(ring)).otherwise(ring).cast(POINTS)


def _left_part(points: Column, a: Column, b: Column) -> Column:
    """The part of a ring on the left of the line from ``a`` to ``b``."""
    none = F.array().cast(POINTS)
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    measured = F.transform(points, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), (dx * (p["y"] - a["y"]) - dy * (p["x"] - a["x"])).alias("d")))

    def step(s: Column) -> Column:
        p, q = s["a"], s["b"]
        t = p["d"] / F.nullif(p["d"] - q["d"], F.lit(0.0))
        at = F.struct((p["x"] + t * (q["x"] - p["x"])).alias("x"), (p["y"] + t * (q["y"] - p["y"])).alias("y"))
        crossing = F.when((p["d"] >= 0) != (q["d"] >= 0), F.array(at).cast(POINTS)).otherwise(none)
        return F.concat(crossing, F.when(q["d"] >= 0, F.array(F.struct(q["x"].alias("x"), q["y"].alias("y"))).cast(POINTS)).otherwise(none))

    return _once(measured, lambda m: F.flatten(F.transform(_pairs(m), step)).cast(POINTS))


def cut_by_convex(ring: Column, cutter: Column) -> Column:
    """The part of a ring inside a convex anticlockwise one: a fold over the cutter's edges, each of which takes what lies to its right."""
    return F.aggregate(_pairs(cutter), ring.cast(POINTS), lambda points, e: _left_part(points, e["a"], e["b"]))


def subdivided(features: DataFrame, most: int = 512, depth: int = 16) -> DataFrame:
    """``features`` with rings of over ``most`` points halved along their longer side until none is left, ``depth`` times at most; one row a piece.

    A ring that isn't convex may come as a piece that touches itself along the cut; areas hold.
    """
    point = lambda x, y: F.struct(F.lit(x).cast("double").alias("x"), F.lit(y).cast("double").alias("y"))
    apart = lambda r: F.filter(r, lambda p, i: p != F.element_at(r, F.pmod(i - 1 + F.size(r), F.size(r)) + 1))

    def halved(ring: Column) -> Column:
        span = lambda k: F.struct(F.array_min(F.transform(ring, lambda p: p[k])).alias("lo"), F.array_max(F.transform(ring, lambda p: p[k])).alias("hi"))

        def halves(box: Column) -> Column:
            wide = box["x"]["hi"] - box["x"]["lo"] >= box["y"]["hi"] - box["y"]["lo"]
            x, y = (box["x"]["lo"] + box["x"]["hi"]) / 2.0, (box["y"]["lo"] + box["y"]["hi"]) / 2.0
            a = F.when(wide, point(x, 0.0)).otherwise(point(0.0, y))
            b = F.when(wide, point(x, 1.0)).otherwise(point(1.0, y))
            both = F.array(_left_part(ring, a, b), _left_part(ring, b, a))
            return F.filter(F.transform(both, lambda r: apart(r)), lambda r: F.size(r) > 2)

        split = _once(F.struct(span("x").alias("x"), span("y").alias("y")), halves)
        return F.when(F.size(ring) > most, split).otherwise(F.array(ring))

    pieces = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.array(F.col("ring").cast(POINTS)), lambda parts, _: F.flatten(F.transform(parts, halved)))
    return features.withColumn("ring", F.explode(pieces))


def _boxed(features: DataFrame, points: Column, cell: float) -> DataFrame:
    """Adds the box ``x0, y0, x1, y1`` and a row for each bin (``_bx, _by``) that it covers."""
    axis = lambda f, k: f(F.transform(points, lambda p: p[k]))
    boxed = features.withColumns({"x0": axis(F.array_min, "x"), "y0": axis(F.array_min, "y"), "x1": axis(F.array_max, "x"), "y1": axis(F.array_max, "y")})
    return _binned(boxed.filter("x0 is not null"), cell)


def _binned(boxed: DataFrame, cell: float, inside: bool = False) -> DataFrame:
    """A row for each bin (``_bx, _by``) that a box covers; with ``inside`` not for those that it only touches with its right or upper side."""
    last = (lambda v: F.greatest(F.ceil(F.col(v[1]) / cell) - 1, F.floor(F.col(v[0]) / cell))) if inside else (lambda v: F.floor(F.col(v[1]) / cell))
    bins = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / cell), last((low, high))))
    return boxed.withColumn("_bx", bins("x0", "x1")).withColumn("_by", bins("y0", "y1"))


def _meeting(a: DataFrame, b: DataFrame, keys: list[str], cell: float, inside: bool = False) -> DataFrame:
    """Pairs ``_l, _r`` (structs) of both sides' binned rows whose boxes meet (with ``inside``, by more than their rims), once each.

    By a merge: what features are cut into is far more than their file makes Spark expect, so it isn't broadcast.
    """
    side = lambda d, s: d.select(*keys, "_bx", "_by", F.struct(*d.columns).alias(s))
    met = side(a, "_l").hint("merge").join(side(b, "_r"), [*keys, "_bx", "_by"])
    low = lambda k: F.floor(F.greatest(f"_l.{k}0", f"_r.{k}0") / cell)
    before = (lambda p, q: F.col(p) < F.col(q)) if inside else (lambda p, q: F.col(p) <= F.col(q))
    boxes = before("_l.x0", "_r.x1") & before("_r.x0", "_l.x1") & before("_l.y0", "_r.y1") & before("_r.y0", "_l.y1")
    return met.filter(boxes & (low("x") == F.col("_bx")) & (low("y") == F.col("_by")))


def _cuts(a: DataFrame, b: DataFrame, keys: list[str], cell: float, same: bool) -> DataFrame:
    """``keys, low, high, area`` of what a feature of ``a`` and one of ``b`` share; if both are the ``same`` features, each pair once.

    Convex parts meet by their bins, so what is dealt into many bins has four corners however long its ring is, and what pairs of parts share is added up by feature.
    """
    parts = lambda d: convex_parts(d, [*keys, "id"], boxed=True)
    return _part_cuts(parts(a), parts(b), keys, cell, same)


def _part_cuts(a: DataFrame, b: DataFrame, keys: list[str], cell: float, same: bool) -> DataFrame:
    """What ``_cuts`` gives, for features that are cut into boxed convex parts already."""
    met = _meeting(_binned(a, cell, True), _binned(b, cell, True), keys, cell, True)
    met = met.filter("_l.id < _r.id") if same else met
    read = met.select(*keys, F.col("_l.id").alias("low"), F.col("_r.id").alias("high"), F.col("_l.ring").alias("_p"), F.col("_r.ring").alias("_q"))
    n = len(keys) + 2

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                area = shared_areas(corners_of(batch.column(n))[0], corners_of(batch.column(n + 1))[0])
                found = pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(n)), pa.array(area)], [*batch.schema.names[:n], "area"])
                yield found.filter(pa.array(area > 0))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:n])
    return mapped(read, cut, f"{kinds}, area double").groupBy(*keys, "low", "high").agg(F.sum("area").alias("area"))


def boundary(features: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, ax, ay, bx, by`` of all edges, run through with the inside on the left."""
    clockwise = lambda r: F.when(signed_area(r) > 0, F.reverse(r)).otherwise(r).cast(POINTS)
    rings = F.concat(F.array(_anticlockwise(F.col("ring"))), F.transform(holes_of(features), clockwise))
    edges = features.select(*keys, F.explode(rings).alias("r")).select(*keys, F.explode(_once(F.col("r"), _pairs)).alias("e")).filter("e.a <> e.b")
    return edges.select(*keys, *(F.col(f"e.{end}.{k}").alias(f"{end}{k}") for end in "ab" for k in "xy"))


def _spans(met: DataFrame, keys: list[str], along: str) -> DataFrame:
    """``keys, segment, lo, hi``: the range of a segment's parameter inside a convex ring, for rows ``_l`` with a segment and ``_r`` with a ring.

    A segment along one of the ring's edges is inside with ``along`` "either", with "same" only if it runs the edge's way, with "none" never.
    """
    read = met.select(*keys, F.col("_l.segment").alias("segment"), F.col("_r.ring").alias("_ring"))
    n = len(keys) + 1

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ends = dict(zip(("ax", "ay", "bx", "by"), (c.to_numpy(zero_copy_only=False) for c in batch.column(n - 1).flatten())))
            sx, sy = ends["bx"] - ends["ax"], ends["by"] - ends["ay"]
            far = np.maximum(np.max(np.abs(np.stack(list(ends.values()))), axis=0), 1.0)
            ring, counts = corners_of(batch.column(n))
            lo, hi = np.zeros(len(ring)), np.ones(len(ring))
            for e in range(int(counts.max())):
                a, b = ring[:, e], ring[np.arange(len(ring)), (e + 1) % counts]
                dx, dy = (b - a).T
                still = 1e-12 * (np.abs(dx) + np.abs(dy)) * far
                d0, d1 = (np.where(np.abs(d) <= still, 0.0, d) for d in (dx * (ends[f"{k}y"] - a[:, 1]) - dy * (ends[f"{k}x"] - a[:, 0]) for k in "ab"))
                t = np.divide(d0, d0 - d1, out=np.zeros_like(d0), where=d0 != d1)
                on = (d0 == 0) & (d1 == 0) & (dx * sx + dy * sy <= 0 if along == "same" else along == "none")
                outside = on | ((d0 < 0) & (d1 < 0)) | ((d0 < 0) & (d1 == 0)) | ((d0 == 0) & (d1 < 0))
                own = e < counts
                lo = np.where(own & outside, 2.0, np.where(own & (d0 < 0) & (d1 > 0), np.maximum(lo, t), lo))
                hi = np.where(own & (d0 > 0) & (d1 < 0), np.minimum(hi, t), hi)
            found = pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(n)), pa.array(lo), pa.array(hi)], [*batch.schema.names[:n], "lo", "hi"])
            yield found.filter(pa.array(lo < hi))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:n])
    return mapped(read, within, f"{kinds}, lo double, hi double")


def _segments(edges: DataFrame, keys: list[str]) -> DataFrame:
    at = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return edges.select(*keys, F.struct("ax", "ay", "bx", "by").alias("segment"), F.array(at("ax", "ay"), at("bx", "by")).alias("ends"))


def _segment_length() -> Column:
    return F.sqrt((F.col("segment.bx") - F.col("segment.ax")) ** 2 + (F.col("segment.by") - F.col("segment.ay")) ** 2)


def _shared_rims(pairs: DataFrame, features: DataFrame, parts: DataFrame, keys: list[str], cell: float) -> DataFrame:
    """``keys, low, high, rim`` of what pairs of features share: each one's boundary inside the other, and once where both run the same way.

    Only features that are in a pair have their boundary worked out; ``parts`` are the features' boxed convex parts.
    """
    pair = [*keys, "low", "high"]
    found = None
    for own, other, along in (("low", "high", "same"), ("high", "low", "none")):
        mine = _boxed(_segments(boundary(features.withColumnRenamed("id", own).hint("merge").join(pairs, [*keys, own]), pair), pair), F.col("ends"), cell)
        theirs = _binned(parts.withColumnRenamed("id", other).hint("merge").join(pairs, [*keys, other]).select(*pair, "ring", "x0", "y0", "x1", "y1"), cell)
        spans = _spans(_meeting(mine, theirs, pair, cell), pair, along)
        inside = interval_union(spans, [*pair, "segment"]).select(*pair, ((F.col("hi") - F.col("lo")) * _segment_length()).alias("length"))
        found = inside if found is None else found.unionByName(inside)
    return found.groupBy(*pair).agg(F.sum("length").alias("rim"))


def overlap_pairs(features: DataFrame, cell: float, keys: list[str] | None = None, least_area: float = 1.0, parts: DataFrame | None = None) -> DataFrame:
    """Pairs of features (of equal ``keys``) that share over ``least_area``: ``low, high, area, width``. Rings may be of any simple form, with ``holes``.

    The width is twice the area over the rim of what is shared, so a long hairline along a common edge counts as thin however long it is.
    Features are cut into ``parts`` once (``keys, id`` and boxed convex parts), unless these are given.
    """
    keys = keys or []
    parts = written(convex_parts(features, [*keys, "id"], boxed=True), "parts") if parts is None else parts
    pairs = written(_part_cuts(parts, parts, keys, cell, True).filter(F.col("area") > least_area), "pairs")
    rims = _shared_rims(pairs.drop("area"), features, parts, keys, cell)
    return pairs.hint("merge").join(rims, [*keys, "low", "high"], "left").select(*keys, "low", "high", "area", (F.col("area") * 2.0 / F.col("rim")).alias("width"))


def dissolved(features: DataFrame, keys: list[str]) -> DataFrame:
    """The boundary of the union of a coverage's parts (holes too) by ``keys``: ``keys, ax, ay, bx, by, times``.

    Rings are turned the same way, so an edge between two parts is run through both ways and the two cancel in one aggregation.
    ``times`` is over 1 where parts lie on each other.
    """
    at = lambda end: F.struct(F.col(f"{end}x").alias("x"), F.col(f"{end}y").alias("y")).alias(end)
    edges = boundary(features, keys).select(*keys, at("a"), at("b"))
    forth = F.when(F.col("a") < F.col("b"), 1).otherwise(-1)
    sums = edges.select(*keys, F.least("a", "b").alias("p"), F.greatest("a", "b").alias("q"), forth.alias("way")).groupBy(*keys, "p", "q").agg(F.sum("way").alias("way")).filter("way <> 0")
    turn = lambda one, two, k: F.when(F.col("way") > 0, F.col(f"{one}.{k}")).otherwise(F.col(f"{two}.{k}"))
    return sums.select(*keys, turn("p", "q", "x").alias("ax"), turn("p", "q", "y").alias("ay"), turn("q", "p", "x").alias("bx"), turn("q", "p", "y").alias("by"), F.abs("way").alias("times"))


def coverage_union(features: DataFrame, keys: list[str], slack: float = 1e-6) -> DataFrame:
    """Each union's parts, boundary edges, rim and area, and whether the area is its parts' (``identity``), which it isn't where parts lie on each other edge on edge."""
    parts = features.groupBy(*keys).agg(F.count(F.lit(1)).alias("parts"), F.sum(polygon_area(features)).alias("_sum"))
    step = F.sqrt((F.col("bx") - F.col("ax")) ** 2 + (F.col("by") - F.col("ay")) ** 2)
    rims = dissolved(features, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("edges"), F.sum(step).alias("rim"), (F.sum(F.col("ax") * F.col("by") - F.col("bx") * F.col("ay")) / 2.0).alias("area"))
    met = parts.join(rims, keys, "left").na.fill({"edges": 0, "rim": 0.0, "area": 0.0})
    return met.withColumn("identity", F.abs(F.col("area") - F.col("_sum")) <= F.col("_sum") * slack).drop("_sum")


def gate_partition(before: DataFrame, after: DataFrame, keys: list[str], cell: float, tolerance: float) -> DataFrame:
    """Each ladder's pairs that overlap wider than the tolerance, the widest overlap, and the drift of its area against what moved boundaries may trade."""
    totals = lambda d, s: d.groupBy(*keys).agg(F.sum(polygon_area(d)).alias(f"area_{s}"), F.sum(polygon_rim(d)).alias(f"rim_{s}"))
    pairs = overlap_pairs(after, cell, keys).groupBy(*keys).agg(F.count(F.when(F.col("width") > tolerance, 1)).alias("wide_pairs"), F.max("width").alias("widest"))
    both = totals(after, "after").join(totals(before, "before"), keys, "left").join(pairs, keys, "left").na.fill({"wide_pairs": 0, "widest": 0.0})
    budget = F.greatest(F.col("area_before") * 1e-5, (F.col("rim_before") + F.col("rim_after")) * (tolerance * 0.5))
    drift = F.abs(F.col("area_after") - F.col("area_before"))
    failed = (F.col("wide_pairs") > 0) | F.coalesce(drift > budget, F.lit(False))
    return both.select(*keys, "wide_pairs", "widest", drift.alias("drift"), budget.alias("budget"), failed.alias("failed"))


def gate_displacement(before: DataFrame, after: DataFrame, keys: list[str], cell: float, tolerance: float) -> DataFrame:
    """Each band's churn, the area that only one side covers, against a band along its boundary; a band that only one side has fails.

    Parts of one side don't overlap, so the sides' areas less twice what pairs of parts share is the churn.
    """
    side = lambda d, s: coverage_union(d, keys).select(*keys, F.col("area").alias(f"area_{s}"), F.col("rim").alias(f"rim_{s}"))
    common = _cuts(before, after, keys, cell, False).groupBy(*keys).agg(F.sum("area").alias("common"))
    both = side(before, "before").join(side(after, "after"), keys, "full_outer").join(common, keys, "left").na.fill({"common": 0.0})
    churn = F.col("area_before") + F.col("area_after") - F.col("common") * 2.0
    budget = (F.col("rim_before") + F.col("rim_after")) * (tolerance * 1.5 * 0.5)
    wrong = F.when(F.col("area_after").isNull(), "gone").when(F.col("area_before").isNull(), "new").when(churn > budget, "moved")
    return both.select(*keys, churn.alias("churn"), budget.alias("budget"), wrong.alias("wrong"))


def covered_routes(routes: DataFrame, features: DataFrame, cell: float) -> DataFrame:
    """The share of each route's length (``route, ax, ay, bx, by, need``) in features whose ``deep`` edge reaches what it needs.

    A segment's stretches in the features' convex parts are ranges of its parameter; their union is its covered part.
    """
    numbered = _segments(routes, ["route", "need"])
    rings = _boxed(convex_parts(features, ["deep"]), F.col("ring"), cell)
    met = _meeting(_boxed(numbered, F.col("ends"), cell), rings, [], cell).filter("_r.deep >= _l.need").withColumn("route", F.col("_l.route"))
    inside = interval_union(_spans(met, ["route"], "either"), ["route", "segment"]).groupBy("route").agg(F.sum((F.col("hi") - F.col("lo")) * _segment_length()).alias("inside"))
    whole = numbered.groupBy("route").agg(F.sum(_segment_length()).alias("length"))
    return whole.join(inside, "route", "left").select("route", (F.coalesce("inside", F.lit(0.0)) / F.nullif("length", F.lit(0.0))).alias("share"))


def gate_routes(before: DataFrame, after: DataFrame, slack: float = 1e-3) -> DataFrame:
    """Routes by name whose covered share fell by over the slack or that are gone; each side as ``covered_routes`` gives it."""
    both = before.select("route", F.col("share").alias("was")).join(after.select("route", F.col("share").alias("now")), "route", "left")
    wrong = F.when(F.col("now").isNull(), "gone").when(F.col("now") < F.col("was") - slack, "less")
    return both.withColumn("wrong", wrong).filter("wrong is not null")


def _outline(xs: list[tuple], least: float, closed: bool) -> set[tuple]:
    """Points of a line that go if the point with the smallest triangle goes first, while that is under ``least``; the ends stay, and three points of a closed line."""
    n = len(xs)
    before, after, gone = [i - 1 for i in range(n)], [i + 1 for i in range(n)], set()

    def triangle(i: int) -> float:
        (ax, ay), (bx, by), (cx, cy) = xs[before[i]], xs[i], xs[after[i]]
        return abs((bx - ax) * (cy - ay) - (cx - ax) * (by - ay)) / 2

    heap = [(triangle(i), xs[i], i) for i in range(1, n - 1)]
    now = {i: v for v, _, i in heap}
    heapify(heap)
    while heap and n - len(gone) > (4 if closed else 2):
        v, _, i = heappop(heap)
        if i in gone or now[i] != v:
            continue
        if v >= least:
            break
        gone.add(i)
        after[before[i]], before[after[i]] = after[i], before[i]
        for k in (before[i], after[i]):
            if 0 < k < n - 1:
                now[k] = triangle(k)
                heappush(heap, (now[k], xs[k], k))
    return {xs[i] for i in gone}


def coverage_simplify(features: DataFrame, keys: list[str], tolerance: float, guard: float = 1e-3) -> DataFrame:
    """``keys, id, ring, simplified``: a coverage's rings without points whose triangle is under ``tolerance`` squared, the smallest first.

    A line between the points where three or more edges meet is simplified once, as a group of its own, and a point that goes is
    taken from every ring that has it, so neighbours keep the same line and no point is invented. Where a ring would lose its third
    point or the area of all rings of the same ``keys`` would change by over ``guard``, these keep their points. That lines don't come to cross isn't checked:
    ``overlap_pairs`` finds it.
    """
    own = features.select(*keys, "id", "ring")
    edges = own.select(*keys, F.explode(_pairs(F.col("ring"))).alias("e")).filter("e.a <> e.b").select(*keys, F.least("e.a", "e.b").alias("p"), F.greatest("e.a", "e.b").alias("q")).distinct()
    edges = written(edges.withColumn("edge", F.monotonically_increasing_id()), "edges")
    ends = edges.select(*keys, "edge", F.explode(F.array("p", "q")).alias("p"))
    met = ends.groupBy(*keys, "p").agg(F.count(F.lit(1)).alias("n"), F.min("edge").alias("a"), F.max("edge").alias("b")).filter("n = 2")
    lines = edges.join(components(met.select("a", "b")).withColumnRenamed("node", "edge"), "edge").select(*keys, "label", F.col("p.x").alias("ax"), F.col("p.y").alias("ay"), F.col("q.x").alias("bx"), F.col("q.y").alias("by"))
    def walk(lines: list) -> list[tuple]:
        ways = defaultdict(list)
        for e in lines:
            ways[e["ax"], e["ay"]].append((e["bx"], e["by"]))
            ways[e["bx"], e["by"]].append((e["ax"], e["ay"]))
        stops = [p for p, to in ways.items() if len(to) == 1]
        at = min(stops or ways)
        line = [at]
        while ways[at]:
            to = min(ways[at])
            ways[at].remove(to)
            ways[to].remove(at)
            line.append(at := to)
        return sorted(_outline(line, tolerance**2, not stops))

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [walk(line) for line in batch.column(len(keys)).to_pylist()]
            at = pa.array(np.repeat(np.arange(len(found)), [len(g) for g in found]), pa.int64())
            xy = [pa.array([p[i] for g in found for p in g], pa.float64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(len(keys))), *xy], [*keys, "x", "y"])

    plane = ", ".join([*(f"`{k}` {features.schema[k].dataType.simpleString()}" for k in keys), "x double, y double"])
    # A line is a row, so many short ones are walked in one batch.
    rows = lines.groupBy(*keys, "label").agg(F.collect_list(F.struct("ax", "ay", "bx", "by")).alias("line")).select(*keys, "line")
    gone = mapped(rows, walked, plane)
    points = own.select(*keys, "id", F.posexplode("ring").alias("_k", "p")).select(*keys, "id", "_k", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    left = points.join(gone, [*keys, "x", "y"], "left_anti").groupBy(*keys, "id").agg(F.sort_array(F.collect_list(F.struct("_k", "x", "y"))).alias("_ring"))
    short = F.transform("_ring", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).cast(POINTS)
    both = written(own.join(left.select(*keys, "id", short.alias("_short")), [*keys, "id"], "left"), "simplified")
    was, now = F.sum(ring_area(F.col("ring"))), F.sum(ring_area(F.col("_short")))
    thin = F.max(F.coalesce(F.size("_short") < 3, F.lit(True)))
    sound = both.filter(F.size("ring") > 2).groupBy(*keys).agg((~thin & (F.abs(now - was) <= was * guard)).alias("_sound"))
    use = F.coalesce("_sound", F.lit(False)) & F.col("_short").isNotNull()
    return both.join(sound, keys, "left").select(*keys, "id", F.when(use, F.col("_short")).otherwise(F.col("ring").cast(POINTS)).alias("ring"), use.alias("simplified"))
