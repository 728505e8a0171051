"""Polygons of any simple rings, with holes: convex parts, measures, repair of rings that cross themselves.

Features have a ``ring`` (``array<struct<x, y>>``, either way round, the last point not repeated) and may have ``holes``, an array of such rings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundgrid.operators.vectors import ring_area, ring_length
from soundgrid.shipping import mapped

POINTS = "array<struct<x: double, y: double>>"
RINGS = f"array<{POINTS}>"
_ARROW = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
#: Edges after which a polygon is cut in two before its bands are worked out, so that their number stays near that of its edges.
_MOST = 512


def holes_of(features: DataFrame) -> Column:
    """The features' holes; none where they have no such column or it is null."""
    none = F.array().cast(RINGS)
    return F.coalesce(F.col("holes").cast(RINGS), none) if "holes" in features.columns else none


def polygon_area(features: DataFrame) -> Column:
    return ring_area(F.col("ring")) - F.aggregate(holes_of(features), F.lit(0.0), lambda s, h: s + ring_area(h))


def polygon_rim(features: DataFrame) -> Column:
    return ring_length(F.col("ring")) + F.aggregate(holes_of(features), F.lit(0.0), lambda s, h: s + ring_length(h))


def half_plane(ring: np.ndarray, axis: int, at: float, below: bool) -> np.ndarray:
    """The part of a ring on one side of an axis-parallel line. Where the ring leaves the side more than once, its parts hang together along the line."""
    side = ring[:, axis] <= at if below else ring[:, axis] >= at
    after = np.roll(ring, -1, axis=0)
    cross = side != np.roll(side, -1)
    t = np.divide(at - ring[:, axis], after[:, axis] - ring[:, axis], out=np.zeros(len(ring)), where=cross)[:, None]
    new = ring + t * (after - ring)
    new[:, axis] = at
    out = np.empty((len(ring), 2, 2))
    out[:, 0], out[:, 1] = ring, new
    return out.reshape(-1, 2)[np.column_stack([side, cross]).ravel()]


def _halves(rings: list[np.ndarray], most: int) -> Iterator[list[np.ndarray]]:
    """A polygon cut across its longer side until no piece has over ``most`` edges or cutting no longer helps."""
    stack = [(rings, 0)]
    while stack:
        rings, depth = stack.pop()
        total = sum(map(len, rings))
        if total <= most or depth > 40:
            yield rings
            continue
        points = np.concatenate(rings)
        span = points.max(axis=0) - points.min(axis=0)
        axis = int(span[1] >= span[0])
        at = float(np.median(points[:, axis]))
        if not points[:, axis].min() < at < points[:, axis].max():
            at = float(points[:, axis].min() + points[:, axis].max()) / 2
        for below in (True, False):
            stack.append(([r for ring in rings if len(r := half_plane(ring, axis, at, below)) > 2], depth + 1))


def trapezoids(rings: list[np.ndarray]) -> np.ndarray:
    """The inside of rings, by the even-odd rule, as anticlockwise trapezoids with level sides: an array of four corners each."""
    a = np.concatenate(rings) if rings else np.zeros((0, 2))
    b = np.concatenate([np.roll(r, -1, axis=0) for r in rings]) if rings else a
    return trapezoids_of(a, b, np.zeros(len(a), np.int64))[0]


def trapezoids_of(a: np.ndarray, b: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trapezoids of many polygons at once, from the edges ``a`` to ``b`` of each ``owner``, and whose they are.

    Lines through all corners cut a polygon into bands. In a band edges don't cross, so every two in their order bound a trapezoid, and
    those of one pair of edges in bands that follow each other are one.
    """
    slanted = a[:, 1] != b[:, 1]
    a, b, owner = a[slanted], b[slanted], owner[slanted]
    if not len(a):
        return np.zeros((0, 4, 2)), owner
    down = a[:, 1] > b[:, 1]
    low, high = np.where(down[:, None], b, a), np.where(down[:, None], a, b)
    # Levels are numbered polygon by polygon.
    level, of = np.concatenate([low[:, 1], high[:, 1]]), np.concatenate([owner, owner])
    order = np.lexsort((level, of))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (level[order][1:] != level[order][:-1]) | (of[order][1:] != of[order][:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(fresh) - 1
    ys, first, last = level[order][fresh], number[: len(low)], number[len(low) :]
    edge = np.repeat(np.arange(len(low)), last - first)
    band = np.arange(len(edge)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + first[edge]

    def x_at(e: np.ndarray, y: np.ndarray) -> np.ndarray:
        t = (y - low[e, 1]) / (high[e, 1] - low[e, 1])
        x = low[e, 0] + t * (high[e, 0] - low[e, 0])
        return np.where(y == low[e, 1], low[e, 0], np.where(y == high[e, 1], high[e, 0], x))

    order = np.lexsort((edge, x_at(edge, (ys[band] + ys[band + 1]) / 2), band))
    left, right, band = edge[order[0::2]], edge[order[1::2]], band[order[0::2]]
    order = np.lexsort((band, right, left))
    left, right, band = left[order], right[order], band[order]
    new = np.ones(len(left), bool)
    new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1]) | (band[1:] != band[:-1] + 1)
    at = np.flatnonzero(new)
    left, right, y0, y1 = left[at], right[at], ys[band[at]], ys[band[np.append(at[1:], len(band)) - 1] + 1]
    out = np.stack([np.column_stack([x_at(e, y), y]) for e, y in ((left, y0), (right, y0), (right, y1), (left, y1))], axis=1)
    wide = (out[:, 0, 0] < out[:, 1, 0]) | (out[:, 3, 0] < out[:, 2, 0])
    return out[wide], owner[left[wide]]


def arrow_rings(column: pa.Array) -> list[np.ndarray | None]:
    """Rings of an array column as arrays of points; null rings and those with a null point are None."""
    out = []
    for ring in column:
        points = ring.values
        if points is None or points.null_count or any(points.field(k).null_count for k in ("x", "y")):
            out.append(None)
        else:
            out.append(np.column_stack([points.field(k).to_numpy(zero_copy_only=False) for k in ("x", "y")]))
    return out


def flat_rings(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The points of an array column of rings, the ring's place for each, and each ring's number of points; null rings, those with a null point and those of under three points have none."""
    counts = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    flat = column.flatten()
    points = np.column_stack([flat.field(k).to_numpy(zero_copy_only=False).astype(float) for k in ("x", "y")]) if len(flat) else np.zeros((0, 2))
    ring = np.repeat(np.arange(len(counts)), counts)
    bad = counts < 3
    if flat.null_count or any(flat.field(k).null_count for k in ("x", "y")):
        null = ~flat.is_valid().to_numpy(zero_copy_only=False)
        for k in ("x", "y"):
            null |= ~flat.field(k).is_valid().to_numpy(zero_copy_only=False)
        bad[ring[null]] = True
    return points[~bad[ring]], ring[~bad[ring]], np.where(bad, 0, counts)


def _after(counts: np.ndarray) -> np.ndarray:
    """For each point of rings of so many points, laid end to end, the place of the one after it in its ring."""
    ends = np.cumsum(counts)
    after = np.arange(1, (int(ends[-1]) if len(ends) else 0) + 1)
    there = counts > 0
    after[ends[there] - 1] = (ends - counts)[there]
    return after


def polygon_edges(rings: pa.Array, holes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The edges of a batch's polygons, from and to, and the row of each; holes of rows without a ring don't count."""
    p, owner, counts = flat_rings(rings)
    edges = [(p, p[_after(counts)], owner)]
    row = np.repeat(np.arange(len(holes)), np.nan_to_num(holes.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64))
    if len(row):
        q, ring, inner = flat_rings(holes.flatten())
        own = counts[row[ring]] > 0
        edges.append((q[own], q[_after(inner)][own], row[ring][own]))
    return tuple(np.concatenate(e) for e in zip(*edges))


def rings_array(rings: list[np.ndarray]) -> pa.Array:
    """Arrays of points as an array column."""
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in rings])]) if rings else np.zeros(1)
    flat = np.concatenate([*rings, np.zeros((0, 2))])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in (0, 1)], ["x", "y"]))


def simple_loops(ring: np.ndarray) -> list[np.ndarray]:
    """A ring cut where it comes to a point again, as rings that don't."""
    _, code = np.unique(ring, axis=0, return_inverse=True)
    code = code.ravel()
    if len(code) == code.max(initial=-1) + 1:
        return [ring]
    out, path, place = [], [], {}
    for i, c in enumerate(code.tolist()):
        if c in place:
            k = place[c]
            out.append(ring[path[k:]])
            for j in path[k + 1 :]:
                del place[int(code[j])]
            del path[k + 1 :]
            path[k] = i
        else:
            place[c] = len(path)
            path.append(i)
    return [*out, ring[path]]


def each_polygon(features: DataFrame, keys: list[str], function: Callable[[list[np.ndarray]], list], schema: str, build: Callable[[list], list[pa.Array]]) -> DataFrame:
    """Rows ``keys, ...`` that ``function`` makes of each feature's rings, the outer one first. Features without a ring of three points make none."""
    names = [c.split()[0] for c in schema.split(";")]
    read = features.select(*keys, F.col("ring").cast(POINTS).alias("ring"), holes_of(features).alias("holes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, made = [], []
            for i, (ring, holes) in enumerate(zip(arrow_rings(batch.column(len(keys))), batch.column(len(keys) + 1))):
                if ring is None or len(ring) < 3:
                    continue
                inner = [h for h in arrow_rings(holes.values) if h is not None and len(h) > 2] if holes.values is not None else []
                new = function([ring, *inner])
                owner += [i] * len(new)
                made += new
            at = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in range(len(keys))), *build(made)], [*keys, *names])

    kinds = [f"`{k}` {features.schema[k].dataType.simpleString()}" for k in keys]
    return mapped(read, run, ", ".join([*kinds, *schema.split(";")]))


def convex_parts(features: DataFrame, keys: list[str], most: int = _MOST, boxed: bool = False) -> DataFrame:
    """``keys, ring``: convex anticlockwise parts, of four corners at most, that together are a feature's inside, holes left out. With ``boxed`` their boxes ``x0, y0, x1, y1``, too.

    A pass over the features without a shuffle. A polygon of many edges is halved first, so the parts stay about as many as its edges. Rings are taken as simple (see
    ``repaired`` for those that aren't); features without three points have no part.
    """

    sides = ["x0", "y0", "x1", "y1"] if boxed else []
    names = [*keys, "ring", *sides]
    read = features.select(*keys, F.col("ring").cast(POINTS).alias("ring"), holes_of(features).alias("holes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, owner = polygon_edges(batch.column(len(keys)), batch.column(len(keys) + 1))
            many = np.bincount(owner, minlength=batch.num_rows) > most
            pieces = [(a[~many[owner]], b[~many[owner]], owner[~many[owner]])]
            for i in np.flatnonzero(many):
                own = arrow_rings(batch.column(len(keys)).slice(i, 1)) + (arrow_rings(batch.column(len(keys) + 1)[int(i)].values) if batch.column(len(keys) + 1)[int(i)].values is not None else [])
                made = [trapezoids(piece) for piece in _halves([r for r in own if r is not None and len(r) > 2], most)]
                pieces.append((np.concatenate(made), None, np.full(sum(map(len, made)), i)))
            found = [trapezoids_of(*pieces[0]), *((t, i) for t, _, i in pieces[1:])]
            corners, owner = np.concatenate([t for t, _ in found]), np.concatenate([i for _, i in found]).astype(np.int64)
            kept = (corners != np.roll(corners, 1, axis=1)).any(axis=2)
            bounds = np.concatenate([[0], np.cumsum(kept.sum(axis=1))])
            flat = corners[kept]
            rings = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in (0, 1)], ["x", "y"]))
            boxes = [pa.array(np.ascontiguousarray(v[:, k])) for v in (corners.min(axis=1), corners.max(axis=1)) for k in (0, 1)] if boxed else []
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(owner)) for k in range(len(keys))), rings, *boxes], names)

    kinds = [f"`{k}` {features.schema[k].dataType.simpleString()}" for k in keys]
    return mapped(read, run, ", ".join([*kinds, f"ring {POINTS}", *(f"{c} double" for c in sides)]))


def corners_of(rings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The corners of a batch of convex parts, four each, the last one repeated where a part has fewer, and how many it has."""
    counts = rings.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = rings.flatten()
    points = np.column_stack([flat.field(k).to_numpy(zero_copy_only=False) for k in ("x", "y")])
    start = np.cumsum(counts) - counts
    return points[start[:, None] + np.minimum(np.arange(4), counts[:, None] - 1)], counts


def shared_areas(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The areas that convex anticlockwise rings (``n`` by corners by 2) share, pair by pair: a cut after each edge of ``q``, which takes what lies to its right."""
    rows = np.arange(len(p))[:, None]
    for e in range(q.shape[1]):
        a = q[:, e, None]
        step = q[:, (e + 1) % q.shape[1], None] - a
        side = step[..., 0] * (p[..., 1] - a[..., 1]) - step[..., 1] * (p[..., 0] - a[..., 0])
        after, beyond = np.roll(p, -1, axis=1), np.roll(side, -1, axis=1)
        cross = (side >= 0) != (beyond >= 0)
        t = np.divide(side, side - beyond, out=np.zeros_like(side), where=cross)[..., None]
        made = np.stack([p + t * (after - p), after], axis=2).reshape(len(p), -1, 2)
        there = np.stack([cross, beyond >= 0], axis=2).reshape(len(p), -1)
        left = there.sum(axis=1)
        order = np.argsort(~there, axis=1, kind="stable")
        p = made[rows, order[rows, np.minimum(np.arange(max(int(left.max(initial=0)), 1)), np.maximum(left[:, None] - 1, 0))]]
    p = p - p[:, :1]
    after = np.roll(p, -1, axis=1)
    return np.abs((p[..., 0] * after[..., 1] - after[..., 0] * p[..., 1]).sum(axis=1)) / 2


# Repair.


def _near_pairs(a: np.ndarray, b: np.ndarray, chunk: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of segments whose boxes meet, some at a time: by the order of their left ends."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.argsort(low[:, 0], kind="stable")
    low, high = low[order], high[order]
    counts = np.searchsorted(low[:, 0], high[:, 0], "right") - np.arange(len(a)) - 1
    ends = np.cumsum(counts)
    k = 0
    while k < len(a):
        stop = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + chunk, "right")))
        i = np.repeat(np.arange(k, stop), counts[k:stop])
        j = np.arange(len(i)) - np.repeat(np.cumsum(counts[k:stop]) - counts[k:stop], counts[k:stop]) + i + 1
        meet = (low[i, 1] <= high[j, 1]) & (low[j, 1] <= high[i, 1])
        yield order[i[meet]], order[j[meet]]
        k = stop


def _crossed(a: np.ndarray, b: np.ndarray, grid: float) -> tuple[np.ndarray, np.ndarray]:
    """Segments and the places within them at which others cross or touch them; crossings are on a ``grid``, and what is as near as that touches."""
    cross = lambda u, v: u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]
    owner, place = [np.zeros(0, np.int64)], [np.zeros((0, 2))]
    for i, j in _near_pairs(a, b):
        d = [cross(b[k] - a[k], p - a[k]) for k, p in ((i, a[j]), (i, b[j]), (j, a[i]), (j, b[i]))]
        room = [np.hypot(*(b[k] - a[k]).T) * grid for k in (i, i, j, j)]
        d = [np.where(np.abs(v) <= r, 0.0, v) for v, r in zip(d, room)]
        through = (d[0] * d[1] < 0) & (d[2] * d[3] < 0)
        t = (d[2][through] / (d[2][through] - d[3][through]))[:, None]
        at = np.round((a[i[through]] + t * (b[i[through]] - a[i[through]])) / grid) * grid
        found = [(i[through], at), (j[through], at)]
        for of, turn, p in ((i, d[0], a[j]), (i, d[1], b[j]), (j, d[2], a[i]), (j, d[3], b[i])):
            on = turn == 0
            found.append((of[on], p[on]))
        for of, p in found:
            along = ((p - a[of]) * (b[of] - a[of])).sum(axis=1)
            inner = (along > 0) & (along < ((b[of] - a[of]) ** 2).sum(axis=1)) & (p != a[of]).any(axis=1) & (p != b[of]).any(axis=1)
            owner.append(of[inner])
            place.append(p[inner])
    return np.concatenate(owner), np.concatenate(place)


def noded(a: np.ndarray, b: np.ndarray, rounds: int = 16) -> tuple[np.ndarray, np.ndarray, bool]:
    """Segments cut wherever they cross or touch, until none do, and whether any did. Cuts are on a grid of about a billionth of the whole; rounding may move one onto another segment, hence the rounds."""
    any_cut = False
    extent = max(float(np.ptp(np.concatenate([a, b]), axis=0).max(initial=0)), float(np.abs(a).max(initial=0)) * 1e-6, 1e-300)
    grid = 2.0 ** (np.ceil(np.log2(extent)) - 32)
    for _ in range(rounds):
        owner, place = _crossed(a, b, grid)
        if not len(owner):
            break
        any_cut = True
        every, points = np.concatenate([np.arange(len(a)), owner, np.arange(len(a))]), np.concatenate([a, place, b])
        along = ((points - a[every]) * (b[every] - a[every])).sum(axis=1)
        along[: len(a)], along[len(a) + len(owner) :] = -np.inf, np.inf
        order = np.lexsort((along, every))
        every, points = every[order], points[order]
        step = (every[1:] == every[:-1]) & (points[1:] != points[:-1]).any(axis=1)
        a, b = points[:-1][step], points[1:][step]
    return a, b, any_cut


def _inside_left(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the even-odd inside of noded segments lies to the left of each: by the number of others to the left of its middle, or below it if it is level."""
    out = np.zeros(len(a), bool)
    for axis in (1, 0):  # along which the segment has a length; the ray runs down the other one
        mine = np.flatnonzero((a[:, 1] != b[:, 1]) == (axis == 1))
        span = a[:, axis] != b[:, axis]
        p, q = a[span], b[span]
        for part in np.array_split(mine, max(1, len(mine) * max(len(p), 1) >> 22)):
            m = (a[part] + b[part]) / 2
            over = (p[:, axis] > m[:, axis, None]) != (q[:, axis] > m[:, axis, None])
            with np.errstate(invalid="ignore", divide="ignore"):
                at = p[:, 1 - axis] + (m[:, axis, None] - p[:, axis]) / (q[:, axis] - p[:, axis]) * (q[:, 1 - axis] - p[:, 1 - axis])
            own = np.full(len(a), -1)
            own[span] = np.arange(len(p))
            hit = over & (at < m[:, 1 - axis, None])
            hit[np.arange(len(part)), own[part]] = False
            odd = hit.sum(axis=1) % 2 == 1
            forth = b[part, axis] > a[part, axis]
            out[part] = odd == forth if axis == 1 else odd != forth
    return out


def _rings_of(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """The simple rings of directed segments with the inside on their left; at a point where several meet, by the sharpest turn to the left."""
    starts: dict[tuple, list[int]] = {}
    for i, p in enumerate(map(tuple, a.tolist())):
        starts.setdefault(p, []).append(i)
    heading = np.arctan2(b[:, 1] - a[:, 1], b[:, 0] - a[:, 0])
    ends = list(map(tuple, b.tolist()))
    used, out = np.zeros(len(a), bool), []
    for first in range(len(a)):
        if used[first]:
            continue
        line, i = [], first
        while not used[i]:
            used[i] = True
            line.append(i)
            back = heading[i] + np.pi
            ways = [k for k in starts[ends[i]] if not used[k] or k == first]
            if not ways:
                break
            i = min(ways, key=lambda k: ((back - heading[k]) % (2 * np.pi)) or 2 * np.pi)
        out += simple_loops(a[line])
    return out


def _signed(ring: np.ndarray) -> float:
    p = ring - ring[0]
    q = np.roll(p, -1, axis=0)
    return float((p[:, 0] * q[:, 1] - q[:, 0] * p[:, 1]).sum()) / 2


def _around(p: np.ndarray, ring: np.ndarray) -> bool:
    q = np.roll(ring, -1, axis=0)
    over = (ring[:, 1] > p[1]) != (q[:, 1] > p[1])
    at = ring[over, 0] + (p[1] - ring[over, 1]) / (q[over, 1] - ring[over, 1]) * (q[over, 0] - ring[over, 0])
    return bool((at < p[0]).sum() % 2)


def repair(rings: list[np.ndarray], least: float = 0.0) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """Valid polygons with the inside, by the even-odd rule, of rings that may cross, touch or run over themselves and each other. Rings that don't come back as they are.

    Segments are cut where they meet; those that are there an even number of times have the same on both sides and go; the others are turned so that the inside is on
    their left and linked. Rings of an area up to ``least`` are left out.
    """
    rings = [r[(r != np.roll(r, 1, axis=0)).any(axis=1)] for r in rings]
    rings = [r for r in rings if len(r) > 2]
    if not rings:
        return []
    a, b = np.concatenate(rings), np.concatenate([np.roll(r, -1, axis=0) for r in rings])
    simple = len(np.unique(a, axis=0)) == len(a)
    a, b, cut = noded(a, b)
    if simple and not cut:
        return [(rings[0], rings[1:])]
    turned = (a[:, 0] > b[:, 0]) | ((a[:, 0] == b[:, 0]) & (a[:, 1] > b[:, 1]))
    pairs, times = np.unique(np.where(turned[:, None], np.column_stack([b, a]), np.column_stack([a, b])), axis=0, return_counts=True)
    pairs = pairs[times % 2 == 1]
    if not len(pairs):
        return []
    p, q = pairs[:, :2], pairs[:, 2:]
    left = _inside_left(p, q)[:, None]
    loops = [(r, _signed(r)) for r in _rings_of(np.where(left, p, q), np.where(left, q, p)) if len(r) > 2]
    outer = sorted(((v, r) for r, v in loops if v > least), key=lambda o: o[0])
    holes: list[list[np.ndarray]] = [[] for _ in outer]
    for ring, v in loops:
        if v < -least:
            middle = (ring[0] + ring[1]) / 2
            owner = next((k for k, (size, r) in enumerate(outer) if size > -v and _around(middle, r)), None)
            if owner is not None:
                holes[owner].append(ring)
    return [(r, h) for (_, r), h in zip(outer, holes)]


def quadrangle(ring: np.ndarray, least: float = 0.0) -> list[tuple[np.ndarray, list[np.ndarray]]] | None:
    """What ``repair`` makes of four corners in plain numbers, if they are plainly convex or two opposite sides plainly cross; else None."""
    (ax, ay), (bx, by), (cx, cy), (dx, dy) = p = ring.tolist()
    xs, ys = (ax, bx, cx, dx), (ay, by, cy, dy)
    extent = max(max(xs) - min(xs), max(ys) - min(ys), max(map(abs, xs + ys)) * 1e-6, 1e-300)
    turn = lambda o, q, r: (q[0] - o[0]) * (r[1] - o[1]) - (q[1] - o[1]) * (r[0] - o[0])
    turns = [turn(p[k - 1], p[k], p[(k + 1) % 4]) for k in range(4)]
    # Far from the room within which corners count as touching.
    room = extent * extent * 1e-6
    if not all(abs(t) > room for t in turns):
        return None
    if all(t > 0 for t in turns) or all(t < 0 for t in turns):
        return [(ring, [])]
    exponent = float(np.ceil(np.log2(extent))) - 32
    grid = 2.0**exponent
    for k in (0, 1):
        a, b, c, d = (p[(k + i) % 4] for i in range(4))
        # Sides a to b and c to d.
        u, v, s, t = turn(a, b, c), turn(a, b, d), turn(c, d, a), turn(c, d, b)
        if u * v < 0 and s * t < 0:
            share = s / (s - t)
            at = [round((a[i] + share * (b[i] - a[i])) / grid) * grid for i in (0, 1)]
            halves = []
            for one, other in ((b, c), (d, a)):
                area = turn(at, one, other) / 2
                if abs(area) <= room:
                    return None
                halves.append((abs(area), np.array([at, one, other] if area > 0 else [at, other, one])))
            return [(r, []) for size, r in sorted(halves, key=lambda h: h[0]) if size > least]
    return None


def repaired(features: DataFrame, keys: list[str], least: float = 0.0) -> DataFrame:
    """``keys, part, ring, holes``: each feature's inside, by the even-odd rule, as valid polygons, the smallest first; one row a polygon. See ``repair``; features without an inside have no row."""

    def mend(rings: list[np.ndarray]) -> list[tuple]:
        known = quadrangle(rings[0], least) if len(rings) == 1 and len(rings[0]) == 4 else None
        if known is not None:
            return [(k, *found) for k, found in enumerate(known)]
        return [(k, *found) for k, found in enumerate(repair(rings, least))]

    def build(made: list[tuple]) -> list[pa.Array]:
        bounds = np.concatenate([[0], np.cumsum([len(h) for _, _, h in made])])
        holes = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rings_array([r for _, _, h in made for r in h]))
        return [pa.array([k for k, _, _ in made], pa.int32()), rings_array([r for _, r, _ in made]), holes]

    return each_polygon(features, keys, mend, f"part int; ring {POINTS}; holes {RINGS}", build)
