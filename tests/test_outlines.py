"""Orders along chains, rings, bands and footprints as polygons, against walks, sampling and counts of cells."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from soundgrid.operators import outlines
from soundgrid.operators.polygons import polygon_area


def test_ranks_of_random_lists_are_those_of_a_walk(spark):
    rng = random.Random(1)
    ids = list(range(200))
    rng.shuffle(ids)
    links, due = [], {}
    while ids:
        own = [ids.pop() for _ in range(min(len(ids), rng.choice([1, 2, 3, 17, 40])))]
        closed = rng.random() < 0.5
        links += list(zip(own, [*own[1:], own[0] if closed else None]))
        k = own.index(min(own)) if closed else 0
        due[min(own) if closed else own[-1]] = (closed, own[k:] + own[:k])
    got: dict[int, list] = {}
    for r in outlines.list_ranks(spark.createDataFrame(links, "id long, next long")).collect():
        got.setdefault(r["chain"], []).append((r["place"], r["id"], r["closed"]))
    assert {c: (v[0][2], [i for _, i, _ in sorted(v)]) for c, v in got.items()} == due
    assert outlines.list_ranks(spark.createDataFrame([], "id long, next long")).count() == 0


def test_chains_and_loops_are_ordered_as_a_walk_goes(spark):
    rng = random.Random(5)
    rows, due, n = [], {}, 0
    for y in range(24):
        length, loop = rng.choice([1, 2, 3, 9, 30]), rng.random() < 0.4
        loop = loop and length > 1
        points = [(float(k), float(y)) for k in range(length + (not loop))]
        if loop:
            points.append(points[0])
        numbers = rng.sample(range(n, n + length), length)
        n += length
        turned = [rng.random() < 0.5 for _ in numbers]
        for i, t, p, q in zip(numbers, turned, points, points[1:]):
            rows.append((i, *(q + p if t else p + q)))
        walk = [(i, p, q) for i, p, q in zip(numbers, points, points[1:])]
        if turned[numbers.index(min(numbers))]:
            walk = [(i, q, p) for i, p, q in reversed(walk)]
        if loop:
            k = [i for i, _, _ in walk].index(min(numbers))
            walk = walk[k:] + walk[:k]
        due[min(numbers)] = walk
    fork = [(n, 0.0, 90.0, 1.0, 90.0), (n + 1, 1.0, 90.0, 2.0, 90.0), (n + 2, 1.0, 90.0, 1.0, 91.0)]
    due |= {i: [(i, (a, b), (c, d))] for i, a, b, c, d in fork}
    rows += fork
    rng.shuffle(rows)
    got: dict[int, list] = {}
    for r in outlines.ordered_chains(spark.createDataFrame(rows, "id long, ax double, ay double, bx double, by double")).collect():
        got.setdefault(r["chain"], []).append((r["place"], r["id"], (r["ax"], r["ay"]), (r["bx"], r["by"])))
    assert {c: [tuple(s[1:]) for s in sorted(v)] for c, v in got.items()} == due


def even_odd(p, rings):
    hit = False
    for ring in rings:
        for a, b in zip(ring, ring[1:] + ring[:1]):
            if (a[1] > p[1]) != (b[1] > p[1]) and a[0] + (p[1] - a[1]) / (b[1] - a[1]) * (b[0] - a[0]) < p[0]:
                hit = not hit
    return hit


def flat(polygons):
    """Band, ring and holes of each polygon as points, rings from their least point on, so that equal ones are equal."""
    turned = lambda r: (lambda p: p[(k := p.index(min(p))) :] + p[:k])([(q["x"], q["y"]) for q in r])
    return sorted((p["band"], turned(p["ring"]), sorted(turned(h) for h in p["holes"])) for p in polygons)


@pytest.fixture(scope="module")
def pixels(spark):
    rng = np.random.default_rng(8)
    z = np.round(-20 * rng.random((26, 26)))
    z[3:9, 4:12], z[14:20, 2:9] = -7.0, -5.0  # flat ground, on a level, too
    rows = [(r, c, float(z[r, c])) for r in range(26) for c in range(26) if rng.random() < 0.9 and not (18 < r < 22 and 15 < c < 21)]
    return {(r, c): v for r, c, v in rows}, spark.createDataFrame(rows + [(30, 30, None)], "r int, c int, z double")


LEVELS = [2.0, 5.0, 10.0]


def test_bands_fill_the_valid_cells_once_and_blocks_do_not_show(spark, pixels):
    known, df = pixels
    got = flat(outlines.band_polygons(df, LEVELS, size=64).collect())
    assert got == flat(outlines.band_polygons(df, LEVELS, size=7).collect())
    measured = sum(area(r) - sum(area(h) for h in holes) for _, r, holes in got)
    assert measured == pytest.approx(len(known), rel=1e-12)
    assert all(signed(r) > 0 and all(signed(h) < 0 for h in holes) for _, r, holes in got)
    for (r, c), z in known.items():  # pixels' middles are in the polygon of their own depth's band
        at = (c + 0.5 + 1e-7, r + 0.5 + 1e-7)
        if all(abs(-z - level) > 1e-3 for level in LEVELS):
            assert [b for b, ring, holes in got if even_odd(at, [ring, *holes])] == [int(np.searchsorted(LEVELS, -z, "right"))]
    rng = random.Random(2)
    for _ in range(400):
        at = (rng.uniform(-1, 27), rng.uniform(-1, 27))
        inside = (int(np.floor(at[1])), int(np.floor(at[0]))) in known
        assert sum(even_odd(at, [ring, *holes]) for _, ring, holes in got) == inside


def signed(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1])) / 2


def area(ring):
    return abs(signed(ring))


def test_footprints_of_cells_with_holes_corners_and_islands_in_holes(spark):
    cells = {(r, c) for r in range(9) for c in range(9)} - {(r, c) for r in range(2, 7) for c in range(2, 7)} | {(4, 4)} | {(9, 9), (10, 9)}
    df = spark.createDataFrame([("a", r, c) for r, c in sorted(cells)] + [("a", 4, 4), ("b", -3, -5)], "k string, r int, c int")
    got = outlines.footprints(df, ["k"], size=4)
    rows = [(r["k"], len(r["ring"]), len(r["holes"]), a) for r, a in ((r, r["a"]) for r in got.withColumn("a", polygon_area(got)).collect())]
    assert sorted(rows) == [("a", 4, 0, 1.0), ("a", 4, 0, 2.0), ("a", 4, 1, 56.0), ("b", 4, 0, 1.0)]


def test_holes_go_to_the_smallest_ring_around_them(spark):
    square = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
    rings = [square(0.0, 0.0, 20.0), square(2.0, 2.0, 16.0)[::-1], square(4.0, 4.0, 12.0), square(6.0, 6.0, 3.0)[::-1], square(11.0, 11.0, 3.0)[::-1], square(30.0, 0.0, 5.0)]
    df = spark.createDataFrame([("k", r) for r in rings], "k string, ring array<struct<x: double, y: double>>")
    got = outlines.with_holes(df, ["k"], row=3.0)
    assert sorted((len(r["holes"]), r["a"]) for r in got.withColumn("a", polygon_area(got)).collect()) == [(0, 25.0), (1, 144.0), (2, 126.0)]


def test_empty_grids_and_lines(spark):
    none = spark.createDataFrame([], "k string, r int, c int, z double")
    assert outlines.band_polygons(none, LEVELS, ["k"]).count() == outlines.footprints(none, ["k"]).count() == 0
    assert outlines.ordered_chains(spark.createDataFrame([], "id long, ax double, ay double, bx double, by double")).count() == 0
    single = outlines.band_polygons(spark.createDataFrame([(0, 0, -3.0)], "r int, c int, z double"), LEVELS)
    assert [(r["band"], len(r["ring"])) for r in single.collect()] == [(1, 4)] and single.select(F.explode("holes")).count() == 0
