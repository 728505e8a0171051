"""Linear interpolation over the Delaunay triangles of scattered nodes, in blocks with halos, and what is found with it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from soundgrid.shipping import ship

#: Beyond this share of its terms' sizes, the sign of a circle test in doubles is right; the other one is for turns.
_CIRCLE_SLACK, _TURN_SLACK = 1.2e-15, 4e-16


def _whole(v: np.ndarray) -> list[int]:
    """Doubles as integers of one scale, exactly."""
    ratios = [float(a).as_integer_ratio() for a in v]
    scale = max((d for _, d in ratios), default=1)
    return [n * (scale // d) for n, d in ratios]


class Mesh:
    """Delaunay triangles by insertion. Signs are exact: doubles decide where they can, integers elsewhere, and where four nodes lie on one circle the rule
    that nodes were lifted by ever smaller steps, most where x and then y is least. So triangles depend on places alone, whatever the order."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.x, self.y = x.tolist(), y.tolist()
        whole = _whole(np.concatenate([x, y]))
        self.wx, self.wy = whole[: len(x)], whole[len(x) :]
        self.corners: dict[int, tuple[int, int, int]] = {}
        self.across: dict[tuple[int, int], int] = {}
        self.made = self.last = 0

    def turn(self, a: int, b: int, c: int) -> int:
        """Positive where the way from a over b to c turns left."""
        x, y = self.x, self.y
        p, q = (x[b] - x[a]) * (y[c] - y[a]), (y[b] - y[a]) * (x[c] - x[a])
        d = p - q
        if abs(d) > _TURN_SLACK * (abs(p) + abs(q)):
            return 1 if d > 0 else -1
        x, y = self.wx, self.wy
        d = (x[b] - x[a]) * (y[c] - y[a]) - (y[b] - y[a]) * (x[c] - x[a])
        return (d > 0) - (d < 0)

    def inside(self, a: int, b: int, c: int, p: int) -> bool:
        """Whether a node is in the circle of an anticlockwise triangle."""
        x, y = self.x, self.y
        ax, ay, bx, by, cx, cy = x[a] - x[p], y[a] - y[p], x[b] - x[p], y[b] - y[p], x[c] - x[p], y[c] - y[p]
        bc, cb, ca, ac, ab, ba = bx * cy, cx * by, cx * ay, ax * cy, ax * by, bx * ay
        a2, b2, c2 = ax * ax + ay * ay, bx * bx + by * by, cx * cx + cy * cy
        d = a2 * (bc - cb) + b2 * (ca - ac) + c2 * (ab - ba)
        if abs(d) > _CIRCLE_SLACK * (a2 * (abs(bc) + abs(cb)) + b2 * (abs(ca) + abs(ac)) + c2 * (abs(ab) + abs(ba))):
            return d > 0
        x, y = self.wx, self.wy
        ax, ay, bx, by, cx, cy = x[a] - x[p], y[a] - y[p], x[b] - x[p], y[b] - y[p], x[c] - x[p], y[c] - y[p]
        d = (ax * ax + ay * ay) * (bx * cy - cx * by) + (bx * bx + by * by) * (cx * ay - ax * cy) + (cx * cx + cy * cy) * (ax * by - bx * ay)
        if d:
            return d > 0
        first = min((a, b, c, p), key=lambda i: (x[i], y[i]))
        if first == p:
            return False
        one, two = (b, c) if first == a else (c, a) if first == b else (a, b)
        return self.turn(p, one, two) > 0

    def add(self, a: int, b: int, c: int) -> None:
        self.made += 1
        self.last = self.made
        self.corners[self.made] = (a, b, c)
        self.across[a, b] = self.across[b, c] = self.across[c, a] = self.made

    def insert(self, p: int) -> None:
        """Walk to the triangle around the node, take out all whose circle it is in, and fan out to their rim."""
        t = self.last
        while True:
            a, b, c = self.corners[t]
            for u, v in ((a, b), (b, c), (c, a)):
                if self.turn(u, v, p) < 0 and (v, u) in self.across:
                    t = self.across[v, u]
                    break
            else:
                break
        gone, rim, stack = {t}, [], [t]
        while stack:
            a, b, c = self.corners[stack.pop()]
            for u, v in ((a, b), (b, c), (c, a)):
                n = self.across.get((v, u))
                if n in gone:
                    continue
                if n is not None and self.inside(*self.corners[n], p):
                    gone.add(n)
                    stack.append(n)
                else:
                    rim.append((u, v))
        for t in gone:
            a, b, c = self.corners.pop(t)
            for edge in ((a, b), (b, c), (c, a)):
                del self.across[edge]
        for u, v in rim:
            self.add(u, v, p)


def _along_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """An order in which neighbours are near each other: by the interleaved bits of a grid's rows and columns."""
    code = np.zeros(len(x), np.int64)
    span = max(np.ptp(x), np.ptp(y)) or 1.0
    i, j = (((v - v.min()) / span * 65535).astype(np.int64) for v in (x, y))
    for bit in range(16):
        code |= ((i >> bit) & 1) << (2 * bit) | ((j >> bit) & 1) << (2 * bit + 1)
    return np.lexsort((y, x, code))


def triangles(x: np.ndarray, y: np.ndarray, reach: float) -> np.ndarray:
    """Delaunay triangles with a circumradius of at most ``reach``, as rows of three node numbers. Nodes have different places.

    No node is in any triangle's circle, by exact signs (see ``Mesh``); nodes on one circle are joined by a rule about their places alone, so all blocks that see the same nodes choose
    the same diagonals. Nodes are inserted along a curve, each found from the one before, in time that grows little faster than their number. The three
    outermost nodes are farther than a circle of the reach can come, so they take no triangle away that counts.
    """
    n = len(x)
    if n < 3:
        return np.zeros((0, 3), np.int64)
    x, y = np.asarray(x, float), np.asarray(y, float)
    x0, y0 = np.round((x.min() + x.max()) / 2), np.round((y.min() + y.max()) / 2)
    far = np.ceil(4 * max(np.hypot(x - x0, y - y0).max(), reach) + 4 * reach)
    mesh = Mesh(np.append(x, [x0 - 2 * far, x0 + 2 * far, x0]), np.append(y, [y0 - far, y0 - far, y0 + 2 * far]))
    mesh.add(n, n + 1, n + 2)
    for i in _along_curve(x, y).tolist():
        mesh.insert(i)
    tri = np.array(list(mesh.corners.values()), np.int64).reshape(-1, 3)
    tri = tri[(tri < n).all(axis=1)]
    tri = np.take_along_axis(tri, np.argsort(np.lexsort((y, x)).argsort()[tri], axis=1), axis=1)
    return tri[circumradius(x[tri], y[tri]) <= reach]


def circumradius(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of triangles given as rows of three corners."""
    a, b, c = (np.hypot(x[:, i] - x[:, j], y[:, i] - y[:, j]) for i, j in ((0, 1), (1, 2), (2, 0)))
    double = np.abs((x[:, 1] - x[:, 0]) * (y[:, 2] - y[:, 0]) - (x[:, 2] - x[:, 0]) * (y[:, 1] - y[:, 0]))
    with np.errstate(divide="ignore"):
        return np.where(double > 0, a * b * c / (2 * double), np.inf)


def interpolated(nx: np.ndarray, ny: np.ndarray, nv: np.ndarray, x: np.ndarray, y: np.ndarray, reach: float) -> np.ndarray:
    """Values at ``x, y`` from the triangle around, NaN outside all. A place on a side belongs to the triangle that gives less."""
    out = np.full(len(x), np.inf)
    order = np.argsort(y, kind="stable")
    sx, sy = x[order], y[order]
    for a, b, c in triangles(nx, ny, reach).tolist():
        low, high = sorted((ny[a], ny[b], ny[c]))[::2]
        i, j = np.searchsorted(sy, [low - 1e-9, high + 1e-9])
        near = i + np.flatnonzero((sx[i:j] >= min(nx[a], nx[b], nx[c]) - 1e-9) & (sx[i:j] <= max(nx[a], nx[b], nx[c]) + 1e-9))
        ux, uy, vx, vy = nx[b] - nx[a], ny[b] - ny[a], nx[c] - nx[a], ny[c] - ny[a]
        dx, dy, det = sx[near] - nx[a], sy[near] - ny[a], ux * vy - uy * vx
        p, q = (dx * vy - dy * vx) / det, (dy * ux - dx * uy) / det
        within = (p >= -1e-9) & (q >= -1e-9) & (p + q <= 1 + 1e-9)
        at = order[near[within]]
        out[at] = np.minimum(out[at], nv[a] + p[within] * (nv[b] - nv[a]) + q[within] * (nv[c] - nv[a]))
    return np.where(np.isfinite(out), out, np.nan)


def interpolate(points: DataFrame, nodes: DataFrame, reach: float, near: float | None = None, size: float | None = None) -> DataFrame:
    """``points(x, y, ...)`` and ``value``, linear over the Delaunay triangles of ``nodes(x, y, v)``.

    Triangles whose circumcircle has a radius over ``reach`` don't count (they span gaps and the nodes' hull), and with ``near`` no place
    farther than that from every node: ``value`` is null there. A circle of that radius around a triangle that has a block's place in it lies within twice the reach
    of the block, so a block sees all nodes that can decide its triangles and the blocks' borders don't show. ``size`` is a block's side, eight times the reach by default. Nodes
    without a value are left out, and of nodes at one place the least value stays.
    """
    size = size or 8 * reach
    span = lambda v: F.explode(F.sequence(F.floor((F.col(v) - 2 * reach) / size), F.floor((F.col(v) + 2 * reach) / size)))
    known = nodes.filter("x is not null and y is not null and v is not null").groupBy(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).agg(F.min(F.col("v").cast("double")).alias("v"))
    sent = known.withColumn("_by", span("y")).withColumn("_bx", span("x"))
    own = [c for c in points.columns if c != "value"]
    dealt = points.select(*own).withColumn("_by", F.floor(F.col("y") / size)).withColumn("_bx", F.floor(F.col("x") / size))
    ship(points.sparkSession)

    def run(places: pd.DataFrame, seen: pd.DataFrame) -> pd.DataFrame:
        found = places[own].copy()
        x, y = (places[c].to_numpy(float, na_value=np.nan) for c in ("x", "y"))
        nx, ny, nv = (seen[c].to_numpy(float) for c in ("x", "y", "v"))
        value = interpolated(nx, ny, nv, x, y, reach)
        if near is not None:
            there = np.flatnonzero(~np.isnan(value))
            for part in np.array_split(there, max(1, len(there) * len(nx) // (1 << 22))):
                d2 = ((x[part, None] - nx) ** 2 + (y[part, None] - ny) ** 2).min(axis=1, initial=np.inf)
                value[part[d2 > near * near]] = np.nan
        found["value"] = pd.Series(value, index=found.index).astype(object).where(~np.isnan(value), None)
        return found

    schema = StructType([*dealt.select(*own).schema.fields, StructField("value", DoubleType())])
    return dealt.groupBy("_by", "_bx").cogroup(sent.groupBy("_by", "_bx")).applyInPandas(run, schema)


def interpolation_gate(pixels: DataFrame, charted: DataFrame, reach: float, tolerance: float = 0.0, stride: int = 1, size: float | None = None) -> DataFrame:
    """How much water of ``pixels(r, c, z)`` is shoaler than interpolation from ``charted(x, y, v)`` implies, ``v`` being a depth; one row.

    Every ``stride``-th row and column counts, at its pixels' centres. ``sampled`` is water inside a triangle, ``violating`` what is shoaler by more than ``tolerance`` (and a millionth),
    with its share, the greatest shortfall and an approximate 99th percentile, which stays mergeable on any number of pixels. Water outside all triangles is nobody's promise.
    """
    wet = pixels.filter((F.col("z") < 0) & (F.col("r") % stride == 0) & (F.col("c") % stride == 0)).select("z", (F.col("c") + 0.5).alias("x"), (F.col("r") + 0.5).alias("y"))
    short = F.col("value") + F.col("z")
    bad = F.count(F.when(short > max(tolerance, 1e-6), 1))
    inside = interpolate(wet, charted, reach, size=size).filter("value is not null")
    return inside.agg(F.count(F.lit(1)).alias("sampled"), bad.alias("violating"), F.coalesce(bad / F.nullif(F.count(F.lit(1)), F.lit(0)), F.lit(0.0)).alias("share"), F.coalesce(F.max(short), F.lit(0.0)).alias("worst"), F.percentile_approx(short, 0.99, 10_000).alias("p99"))


def repaired_soundings(pixels: DataFrame, soundings: DataFrame, keys: list[str], zooms: tuple[int, int], spacing: float = 8.0, least: float = 0.2, excess: float = 2.0, share: float = 0.5, deepest: float = 200.0, most: int = 400, reach: float = 1e5) -> DataFrame:
    """Ground to insert where each tile's displayed soundings promise too little depth: ``keys, zoom, r, c, depth, error``.

    ``pixels(keys, r, c, z)`` are a tile's ground and ``soundings(keys, x, y, v, minzoom, lattice)`` its soundings in pixels of the last zoom. Zoom by zoom, those
    that display there are interpolated: lattice soundings at their own zoom alone (from it on, if it is the last), others from theirs on. Water down to ``deepest`` that is deeper than
    that by over ``excess`` and over ``share`` of its depth goes in, worst first, ``spacing`` pixels of the zoom away from all that display, ``most`` at a zoom;
    ties by row and column. What is inserted displays from its zoom on, so finer zooms see it. Fewer than three displayed soundings, or water under ``least``, change nothing.
    A tile is a group: its pixels and soundings are bounded by its size.
    """
    first, last = zooms
    ship(pixels.sparkSession)

    def run(key: tuple, ground: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        out = []
        ground = ground[ground["z"] < 0].sort_values(["r", "c"])
        x, y, depth = ground["c"].to_numpy(float) + 0.5, ground["r"].to_numpy(float) + 0.5, -ground["z"].to_numpy(float)
        known = known.dropna(subset=["x", "y", "v"])
        place, value = known[["x", "y"]].to_numpy(float), known["v"].to_numpy(float)
        start, capped = known["minzoom"].to_numpy(int), known["lattice"].to_numpy(bool)
        for zoom in range(first, last + 1):
            shown = np.where(capped & (start < last), start == zoom, start <= zoom)
            if shown.sum() < 3 or not len(x):
                continue
            order = np.flatnonzero(shown)[np.lexsort((value[shown], *place[shown].T))]
            at, one = np.unique(place[order], axis=0, return_index=True)
            error = depth - interpolated(*at.T, value[order][one], x, y, reach)
            bad = np.flatnonzero((error > np.maximum(excess, share * depth)) & (depth <= deepest) & (depth >= least))
            apart, taken = spacing * 2.0 ** (last - zoom), []
            for i in bad[np.argsort(-error[bad], kind="stable")].tolist():
                if len(taken) < most and ((at - (x[i], y[i])) ** 2).sum(axis=1).min() >= apart * apart:
                    taken.append(i)
                    at = np.vstack([at, (x[i], y[i])])
            out += [(*key, zoom, int(y[i]), int(x[i]), depth[i], error[i]) for i in taken]
            place, value = np.vstack([place, np.column_stack([x[taken], y[taken]])]), np.append(value, depth[taken])
            start, capped = np.append(start, np.full(len(taken), zoom)), np.append(capped, np.zeros(len(taken), bool))
        return pd.DataFrame(out, columns=[*keys, "zoom", "r", "c", "depth", "error"])

    kinds = [f"{c} {pixels.schema[c].dataType.simpleString()}" for c in keys]
    schema = ", ".join([*kinds, "zoom int, r int, c int, depth double, error double"])
    own = soundings.select(*(F.col(c).alias(c) for c in [*keys, "x", "y", "v", "minzoom", "lattice"]))  # both may come from one table
    return pixels.select(*keys, "r", "c", "z").groupBy(*keys).cogroup(own.groupBy(*keys)).applyInPandas(run, schema)
