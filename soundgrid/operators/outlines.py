"""Outlines: the order of points along chains, rings from directed lines, and polygons of a grid's bands and footprints.

Lines and rings are ``array<struct<x, y>>``. A directed line has the inside on its left.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundgrid.operators.graph import components
from soundgrid.operators.polygons import POINTS, each_polygon, rings_array, simple_loops
from soundgrid.operators.vectors import _pairs, ring_area
from soundgrid.shipping import discard, ship, written


def signed_area(ring: Column) -> Column:
    """Positive where a ring runs anticlockwise."""
    return F.aggregate(_pairs(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]) / 2.0


def list_ranks(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``id, chain, place, closed`` of the members of chains given as ``links(id, next)``, ``next`` null at a chain's end; each id follows one other at most.

    Order by ``place`` along the ``chain``: an open one is named after its last member, a closed one after its least, with which it begins. Every member
    looks twice as far ahead in each round (pointer doubling), so a chain of n members takes log2(n) rounds of one join by equality, and no task reads a
    chain. As no two members look at the same one until they see the end, after which they rest, no key is hot.
    """
    tail = F.col("next").isNull()
    state = links.select("id", F.coalesce("next", "id").alias("to"), F.when(tail, 0).otherwise(1).cast("long").alias("steps"), tail.alias("done"), F.col("id").alias("least"), F.lit(0).cast("long").alias("off"))
    state = written(state, "ranks")
    for _ in range(rounds):
        ahead = state.select(*(F.col(c).alias(f"_{c}") for c in ("id", "to", "steps", "done", "least", "off")))
        met = state.filter("not done").join(ahead, F.col("to") == F.col("_id"))
        nearer = F.col("_least") < F.col("least")
        moved = met.select("id", F.col("_to").alias("to"), (F.col("steps") + F.col("_steps")).alias("steps"), F.col("_done").alias("done"), F.least("least", "_least").alias("least"), F.when(nearer, F.col("steps") + F.col("_off")).otherwise(F.col("off")).alias("off"), (nearer | F.col("_done")).alias("_news"))
        before, state = state, written(state.filter("done").withColumn("_news", F.lit(False)).unionByName(moved), "ranks")
        discard(before)
        if not state.filter("_news").limit(1).count():
            break
        state = state.drop("_news")
    else:
        raise RuntimeError(f"chains not ranked in {rounds} rounds")
    first = F.when(F.col("off") == 0, F.lit(-(1 << 62))).otherwise(-F.col("off"))
    return state.select("id", F.when(F.col("done"), F.col("to")).otherwise(F.col("least")).alias("chain"), F.when(F.col("done"), -F.col("steps")).otherwise(first).alias("place"), (~F.col("done")).alias("closed"))


def ordered_chains(segments: DataFrame) -> DataFrame:
    """``segments(id, ax, ay, bx, by)`` chained where two of them alone meet at a point: ``id, chain, place, ax, ay, bx, by``, turned so that each begins where the one before ends.

    The chain is its least id, whose own direction it takes. Forks end chains. Each segment is ranked both ways round (see ``list_ranks``), and the way in which the least id runs forth stays.
    """
    ways = segments.select((F.col("id") * 2).alias("way"), "ax", "ay", "bx", "by").unionByName(segments.select((F.col("id") * 2 + 1).alias("way"), F.col("bx").alias("ax"), F.col("by").alias("ay"), F.col("ax").alias("bx"), F.col("ay").alias("by")))
    # At a point where two segments meet, each one's way in goes on by the other's way out; a way in and its own way out differ in the last bit.
    starts = ways.groupBy(F.col("ax").alias("x"), F.col("ay").alias("y")).agg(F.count(F.lit(1)).alias("n"), F.min("way").alias("low"), F.max("way").alias("high"))
    starts = starts.filter(F.col("n") == 2).filter(F.shiftright("low", 1) != F.shiftright("high", 1))
    after = F.when(F.col("low").bitwiseXOR(F.lit(1).cast("long")) == F.col("way"), F.col("high")).otherwise(F.col("low"))
    links = ways.join(starts, (F.col("bx") == F.col("x")) & (F.col("by") == F.col("y")), "left").select(F.col("way").alias("id"), F.when(F.col("n").isNotNull(), after).alias("next"))
    ranks = list_ranks(links).withColumnsRenamed({"id": "way", "chain": "list"})
    least = ranks.groupBy("list").agg(F.min("way").alias("least")).filter(F.col("least") % 2 == 0)
    kept = ranks.join(least, "list").join(ways, "way")
    return kept.select(F.shiftright("way", 1).alias("id"), F.shiftright("least", 1).alias("chain"), "place", "ax", "ay", "bx", "by")


def _compass(a: Column, b: Column) -> Column:
    return F.atan2(b["y"] - a["y"], b["x"] - a["x"])


def _untangled(rings: DataFrame, keys: list[str]) -> DataFrame:
    return each_polygon(rings, keys, lambda found: simple_loops(found[0]), f"ring {POINTS}", lambda made: [rings_array(made)])


def closed_rings(lines: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, ring`` from directed ``lines(keys, line)`` that make up closed boundaries.

    Where several lines leave the point at which one ends, it goes on by the sharpest turn to the left, so what the rings bound stays apart where it touches at a point; a ring that comes to a
    point twice is then cut there, so none touches itself. Rings begin with an arbitrary
    point; points on a straight line are left out. A ring is one row; its lines find each other by joins on their ends and get their order by ``list_ranks``.
    """
    at = lambda k: F.element_at("line", k)
    parts = written(lines.select(*keys, F.monotonically_increasing_id().alias("id"), "line"), "lines")
    ends = parts.select(*keys, "id", at(-1).alias("p"), _compass(at(-1), at(-2)).alias("back"))
    starts = parts.select(*keys, F.col("id").alias("next"), at(1).alias("p"), _compass(at(1), at(2)).alias("forth"))
    turn = F.pmod(F.col("back") - F.col("forth"), F.lit(2 * np.pi))
    turn = F.when(turn <= 1e-12, 2 * np.pi).otherwise(turn)
    links = written(ends.join(starts, [*keys, "p"]).groupBy("id").agg(F.min_by("next", turn).alias("next")), "links")
    ranks = list_ranks(links.filter("id <> next"))
    cut = F.slice("line", 1, F.size("line") - 1)
    whole = parts.join(links.filter("id = next"), "id", "left_semi").select(*keys, cut.alias("ring"))
    points = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("place", cut.alias("l")))), lambda s: s["l"]))
    linked = parts.join(ranks.filter("closed"), "id").groupBy(*keys, "chain").agg(points.alias("ring")).drop("chain")
    rings = _untangled(whole.unionByName(linked), keys)
    n = F.size("ring")
    around = lambda i, k: F.element_at("ring", F.pmod(i + k + n, n) + 1)

    def bends(p: Column, i: Column) -> Column:
        a, b = around(i, -1), around(i, 1)
        return (p["x"] - a["x"]) * (b["y"] - p["y"]) != (p["y"] - a["y"]) * (b["x"] - p["x"])

    return rings.select(*keys, F.filter("ring", bends).alias("ring")).filter(F.size("ring") > 2)


def containing(points: DataFrame, rings: DataFrame, keys: list[str], row: float) -> DataFrame:
    """``id, ring_id, area`` of all ``rings(keys, ring_id, ring)`` around each of ``points(keys, id, x, y)``: those with an odd number of edges to its left.

    Points and edges meet by rows of height ``row``; points on a ring's edge may count either way.
    """
    edges = rings.select(*keys, "ring_id", ring_area(F.col("ring")).alias("area"), F.explode(_pairs(F.col("ring"))).alias("e")).select(*keys, "ring_id", "area", "e.*").filter("a.y <> b.y")
    rows = F.sequence(F.floor(F.least("a.y", "b.y") / row), F.floor(F.greatest("a.y", "b.y") / row))
    met = points.withColumn("_row", F.floor(F.col("y") / row)).join(edges.withColumn("_row", F.explode(rows)), [*keys, "_row"])
    crossing = F.col("a.x") + (F.col("y") - F.col("a.y")) / (F.col("b.y") - F.col("a.y")) * (F.col("b.x") - F.col("a.x"))
    hits = met.filter(((F.col("a.y") > F.col("y")) != (F.col("b.y") > F.col("y"))) & (crossing < F.col("x")))
    return hits.groupBy(*keys, "id", "ring_id", "area").agg(F.count(F.lit(1)).alias("n")).filter("n % 2 = 1").drop("n")


def with_holes(rings: DataFrame, keys: list[str], row: float = 1.0) -> DataFrame:
    """``keys, id, ring, holes`` of directed rings: anticlockwise ones are polygons, each clockwise one is a hole of the smallest of them around it.

    Rings don't cross and don't share edges; a hole is where the middle of its first edge is.
    """
    rings = written(rings.select(*keys, F.monotonically_increasing_id().alias("id"), "ring", signed_area(F.col("ring")).alias("_area")), "rings")
    outer, inner = rings.filter("_area > 0"), rings.filter("_area < 0")
    middle = lambda k: ((F.col("ring")[0][k] + F.col("ring")[1][k]) / 2.0).alias(k)
    around = containing(inner.select(*keys, "id", middle("x"), middle("y")), outer.select(*keys, F.col("id").alias("ring_id"), "ring"), keys, row)
    owner = around.groupBy("id").agg(F.min_by("ring_id", F.struct("area", "ring_id")).alias("owner"))
    holes = inner.join(owner, "id").groupBy("owner").agg(F.collect_list("ring").alias("holes"))
    return outer.join(holes, F.col("id") == F.col("owner"), "left").select(*keys, "id", "ring", F.coalesce("holes", F.array().cast(f"array<{POINTS}>")).alias("holes"))


# The eight places around a pixel's middle, anticlockwise, in halves of a pixel: the middles of its sides and its corners.
_AROUND = np.array([(1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1)])


def _mean(values: list[np.ndarray]) -> np.ndarray:
    """The mean of what isn't NaN, summed in the order given."""
    there = sum(np.where(np.isnan(v), 0, 1) for v in values)
    return reduce(lambda s, v: s + np.where(np.isnan(v), 0.0, v), values, 0.0) / np.maximum(there, 1)


def _between(p: np.ndarray, q: np.ndarray, vp: np.ndarray, vq: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Where a level lies between two places, worked out from the lesser place, so both sides of an edge get the same digits."""
    turn = (p[..., 0] > q[..., 0]) | ((p[..., 0] == q[..., 0]) & (p[..., 1] > q[..., 1]))
    a, b = np.where(turn[..., None], q, p), np.where(turn[..., None], p, q)
    va, vb = np.where(turn, vq, vp), np.where(turn, vp, vq)
    with np.errstate(divide="ignore", invalid="ignore"):
        return a + ((level - va) / (vb - va))[..., None] * (b - a)


def band_edges_of(depth: np.ndarray, levels: np.ndarray, top: int, left: int, halo: int) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Band, both ends and part of the directed edges around each band's parts of an array's pixels, ``halo`` of them around left out; and pairs of parts that touch without such an edge.

    A pixel is eight triangles between its middle, the middles of its sides and its corners; a side's middle and a corner have the mean of the pixels there that have a
    value. In a triangle depths are linear, so a band's part of it is convex; parts of one band in neighbouring triangles share whole edges.
    """
    h, w = depth.shape
    core = (slice(halo, h - halo), slice(halo, w - halo))
    wide = np.pad(depth, 1, constant_values=np.nan)
    shift = lambda dx, dy: wide[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w]
    values = []
    for dx, dy in _AROUND.tolist():
        cells = sorted({(0, 0), (dx, 0), (0, dy), (dx, dy)}, key=lambda d: (d[1], d[0]))
        values.append(_mean([shift(*d) for d in cells]))
    values = np.stack(values, axis=-1)
    every = np.concatenate([values, depth[..., None]], axis=-1)
    there = ~np.isnan(depth)
    bands = np.searchsorted(levels, np.where(np.isnan(every), 0.0, every), "right")
    flat = there & (bands == bands[..., :1]).all(axis=-1)
    band = np.where(flat, bands[..., 8], -1)
    found = [(np.zeros(0, np.int64), np.zeros((0, 2)), np.zeros((0, 2)), np.zeros(0, np.int64))]
    # Pixels of one band: their sides, but not those towards another such pixel of the block.
    number = np.arange(h * w).reshape(h, w)
    beside = np.full((h + 2, w + 2), -1)
    beside[1 + halo : 1 + h - halo, 1 + halo : 1 + w - halo] = band[core]
    touching = []
    for one, two in (((slice(None), slice(None, -1)), (slice(None), slice(1, None))), ((slice(None, -1), slice(None)), (slice(1, None), slice(None)))):
        same = (band[core][one] == band[core][two]) & (band[core][one] >= 0)
        touching.append(np.column_stack([number[core][one][same], number[core][two][same]]))
    parts = h * w
    for side, (dx, dy) in enumerate(((1, 0), (0, 1), (-1, 0), (0, -1))):
        open_ = flat & (beside[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w] != band)
        r, c = np.nonzero(open_[core])
        middle = np.column_stack([c + left + halo + 0.5, r + top + halo + 0.5])
        for k in (2 * side - 1, 2 * side):
            found.append((band[core][r, c], middle + _AROUND[k % 8] / 2, middle + _AROUND[(k + 1) % 8] / 2, number[core][r, c]))
    # The others: each triangle, cut by each band that it reaches.
    r, c = np.nonzero((there & ~flat)[core])
    middle = np.column_stack([c + left + halo + 0.5, r + top + halo + 0.5])
    v, own = values[core][r, c], depth[core][r, c]
    for k in range(8):
        corners = np.stack([middle, middle + _AROUND[k] / 2, middle + _AROUND[(k + 1) % 8] / 2], axis=1)
        height = np.column_stack([own, v[:, k], v[:, (k + 1) % 8]])
        low, high = np.searchsorted(levels, height.min(axis=1), "right"), np.searchsorted(levels, height.max(axis=1), "right")
        tri = np.repeat(np.arange(len(low)), high - low + 1)
        which = np.arange(len(tri)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1) + low[tri]
        bounds = np.concatenate([[-np.inf], levels, [np.inf]])
        lo, hi = bounds[which], bounds[which + 1]
        p, q = corners[tri], corners[tri][:, [1, 2, 0]]
        vp, vq = height[tri], height[tri][:, [1, 2, 0]]
        slots, used = np.empty((len(tri), 3, 3, 2)), np.zeros((len(tri), 3, 3), bool)
        slots[:, :, 0], used[:, :, 0] = p, (vp >= lo[:, None]) & (vp <= hi[:, None])
        up = vp < vq
        for j in (1, 2):
            level = np.where(up == (j == 1), lo[:, None], hi[:, None])
            used[:, :, j] = np.isfinite(level) & ((vp < level) & (vq > level) | (vp > level) & (vq < level))
            slots[:, :, j] = _between(p, q, vp, vq, np.where(np.isfinite(level), level, 0.0))
        used, slots = used.reshape(len(tri), 9), slots.reshape(len(tri), 9, 2)
        row = np.nonzero(used)[0]
        points = slots[used]
        counts = used.sum(axis=1)
        ends = np.cumsum(counts)
        after = np.arange(1, len(row) + 1)
        after[ends[counts > 0] - 1] = (ends - counts)[counts > 0]
        apart = (points != points[after]).any(axis=1)
        found.append((which[row][apart], points[apart], points[after][apart], parts + row[apart]))
        parts += len(tri)
    return tuple(np.concatenate(f) for f in zip(*found)), np.concatenate(touching)


def merged(n: int, pairs: np.ndarray) -> np.ndarray:
    """The least of the numbers below ``n`` that each is connected with over pairs."""
    label = np.arange(n)
    while len(pairs):
        ends = label[pairs]
        ends = ends[ends[:, 0] != ends[:, 1]]
        if not len(ends):
            break
        np.minimum.at(label, ends.max(axis=1), ends.min(axis=1))
        while (label[label] != label).any():
            label = label[label]
    return label


def _joined(band: np.ndarray, a: np.ndarray, b: np.ndarray, part: np.ndarray, touching: np.ndarray, box: tuple[int, int, int, int]) -> tuple[list, list, list, list]:
    """Edges of a block without those run through both ways, joined into lines: band, whether it is an edge on the block's border, the patch of connected parts that it bounds, and points."""
    top, left, bottom, right = box
    every = np.concatenate([np.column_stack([band, a]), np.column_stack([band, b])])
    _, code = np.unique(every, axis=0, return_inverse=True)
    code = code.reshape(2, -1)
    low, high = np.minimum(*code), np.maximum(*code)
    pair, where, back = np.unique(low * (code.max(initial=0) + 1) + high, return_index=True, return_inverse=True)
    way = np.bincount(back, np.where(code[0] < code[1], 1, -1), len(pair))
    # Parts on both sides of an edge are connected.
    known, place = np.unique(np.concatenate([part, touching.ravel()]), return_inverse=True)
    order = np.argsort(back, kind="stable")
    next_to = back[order][1:] == back[order][:-1]
    own = place[: len(part)]
    links = np.column_stack([own[order][1:][next_to], own[order][:-1][next_to]])
    patch = merged(len(known), np.concatenate([links, place[len(part) :].reshape(-1, 2)]))[own]
    # An edge may run twice the same way only if it runs back as often, so one of the majority's way is kept for each that is left.
    forth = np.where(code[0] < code[1], 1, -1)
    keep = np.flatnonzero(way[back] * forth > 0)
    keep = keep[np.unique(back[keep], return_index=True)[1]]
    band, a, b, start, end = band[keep], a[keep], b[keep], code[0][keep], code[1][keep]
    on = lambda p: (p[:, 0] == left) | (p[:, 0] == right) | (p[:, 1] == top) | (p[:, 1] == bottom)
    rim = ((a[:, 0] == b[:, 0]) & np.isin(a[:, 0], (left, right))) | ((a[:, 1] == b[:, 1]) & np.isin(a[:, 1], (top, bottom)))
    n = code.max(initial=-1) + 1
    plain = (np.bincount(start, minlength=n) == 1) & (np.bincount(end, minlength=n) == 1)
    leaving = np.full(n, -1)
    leaving[start] = np.arange(len(start))
    passes = plain[end] & ~on(b)
    to = np.where(passes, leaving[end], -1)
    to[rim] = -1
    to = np.where((to >= 0) & ~rim[np.maximum(to, 0)], to, -1)
    # Pointer doubling: the last edge of an open chain, the least of a closed one, and how far ahead it is.
    ahead, steps, done, least, off = np.where(to >= 0, to, np.arange(len(to))), (to >= 0).astype(np.int64), to < 0, np.arange(len(to)), np.zeros(len(to), np.int64)
    while not done.all():
        nearer = least[ahead] < least
        news = (nearer | done[ahead]) & ~done
        off, least = np.where(nearer, steps + off[ahead], off), np.minimum(least, least[ahead])
        steps, done, ahead = steps + steps[ahead], done[ahead], ahead[ahead]
        if not news.any():
            break
    chain = np.where(done, ahead, least)
    place = np.where(done, -steps, np.where(off == 0, -(1 << 60), -off))
    order = np.lexsort((place, chain))
    cuts = np.flatnonzero(np.diff(chain[order])) + 1
    patch = patch[keep]
    out = ([], [], [], [])
    for line in np.split(order, cuts) if len(order) else []:
        out[0].append(int(band[line[0]]))
        out[1].append(bool(rim[line[0]]))
        out[2].append(int(patch[line[0]]))
        out[3].append(np.concatenate([a[line], b[line[-1:]]]))
    return out


def band_lines(pixels: DataFrame, levels: list[float], keys: list[str], size: int = 512) -> DataFrame:
    """``keys, band, patch, line``: directed lines that close to the boundaries of each band of ``pixels(keys, r, c, z)``; 0 is above the first level. Lines of one connected patch have its number.

    A block of ``size`` by ``size`` pixels, with two around it, is a group; it joins its edges into lines as far as its border. Edges on borders come by themselves, and
    where the same band is on both sides they cancel in one aggregation and connect the patches there, so blocks don't show in the result.
    """
    halo = 2
    span = lambda v: F.explode(F.sequence(F.floor((F.col(v) - halo) / size), F.floor((F.col(v) + halo) / size)))
    sent = pixels.filter("z is not null").select(*keys, "r", "c", (-F.col("z")).cast("double").alias("d")).withColumn("_br", span("r")).withColumn("_bc", span("c"))
    marks = np.array(levels, float)
    ship(pixels.sparkSession)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        top, left = (int(k.as_py()) * size for k in key[-2:])
        depth = np.full((size + 2 * halo, size + 2 * halo), np.nan)
        r, c = (table.column(v).to_numpy().astype(np.int64) for v in ("r", "c"))
        depth[r - top + halo, c - left + halo] = table.column("d").to_numpy()
        edges, touching = band_edges_of(depth, marks, top - halo, left - halo, halo)
        bands, rims, patches, lines = _joined(*edges, touching, (top, left, top + size, left + size))
        kept = table.select(keys).take(pa.array([0] * len(bands), pa.int64())) if keys else pa.table({})
        block = [pa.array([k.as_py()] * len(bands), pa.int64()) for k in key[-2:]]
        columns = [*(kept.column(k) for k in keys), *block, pa.array(bands, pa.int32()), pa.array(rims, pa.bool_()), pa.array(patches, pa.int64()), rings_array(lines)]
        return pa.table(columns, [*keys, "_br", "_bc", "band", "rim", "patch", "line"])

    kinds = [f"`{k}` {pixels.schema[k].dataType.simpleString()}" for k in keys]
    found = sent.groupBy(*keys, "_br", "_bc").applyInArrow(run, ", ".join([*kinds, "_br long", "_bc long", "band int", "rim boolean", "patch long", f"line {POINTS}"]))
    lines = written(found.withColumn("patch", F.xxhash64(*keys, "_br", "_bc", "patch")).drop("_br", "_bc"), "band_lines")
    p, q = F.element_at("line", 1), F.element_at("line", 2)
    rims = lines.filter("rim").select(*keys, "band", "patch", F.least(p, q).alias("p"), F.greatest(p, q).alias("q"), F.when(p < q, 1).otherwise(-1).alias("way"))
    rims = written(rims.groupBy(*keys, "band", "p", "q").agg(F.sum("way").alias("way"), F.min("patch").alias("patch"), F.max("patch").alias("other")), "rims")
    left = rims.filter("way <> 0").select(*keys, "band", "patch", F.when(F.col("way") > 0, F.array("p", "q")).otherwise(F.array("q", "p")).alias("line"))
    every = lines.filter("not rim").select(*keys, "band", "patch", "line").unionByName(left)
    patches = components(rims.filter("way = 0 and patch <> other").select(F.col("patch").alias("a"), F.col("other").alias("b")).distinct())
    return every.join(patches, F.col("patch") == F.col("node"), "left").withColumn("patch", F.coalesce("label", "patch")).drop("node", "label")


def band_polygons(pixels: DataFrame, levels: list[float], keys: list[str] | None = None, size: int = 512) -> DataFrame:
    """``keys, band, id, ring, holes``: the polygons of depth bands of ``pixels(r, c, z)``, whose cells they fill without gap or overlap.

    Depths are ``-z``; band k lies from the k-th level (with it) to the next. Between pixels' middles depths are linear over
    triangles (see ``band_edges_of``), so band borders are isolines; at the border to pixels without a value the cell ends.
    """
    own = [*(keys or []), "band"]
    rings = closed_rings(band_lines(pixels, levels, keys or [], size), [*own, "patch"]).withColumn("_area", signed_area(F.col("ring")))
    # A patch has one ring around it; its others run round its holes.
    outer = F.max_by(F.when(F.col("_area") > 0, F.col("ring")), "_area")
    holes = F.collect_list(F.when(F.col("_area") < 0, F.col("ring")))
    return rings.groupBy(*own, "patch").agg(outer.alias("ring"), holes.alias("holes")).select(*own, F.col("patch").alias("id"), "ring", "holes")


def footprints(pixels: DataFrame, keys: list[str], size: int = 512) -> DataFrame:
    """``keys, id, ring, holes``: the outlines of the cells of ``pixels(keys, r, c)``, one polygon for all that touch along sides."""
    cells = pixels.select(*keys, "r", "c").distinct().withColumn("z", F.lit(0.0))
    return band_polygons(cells, [], keys, size).drop("band")
