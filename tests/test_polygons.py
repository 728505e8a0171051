"""Repair of rings that cross themselves: areas against the even-odd rule on finer and finer grids."""

import math
import random

import numpy as np
import pytest

from soundgrid.operators import polygons

RING = polygons.POINTS


def size(parts):
    return sum(abs(polygons._signed(r)) - sum(abs(polygons._signed(h)) for h in holes) for r, holes in parts)


def sampled(rings, n):
    """The even-odd area by the middles of n by n cells."""
    points = np.concatenate(rings)
    low, high = points.min(axis=0) - 0.1, points.max(axis=0) + 0.1
    x, y = (low[k] + (np.arange(n) + 0.5) / n * (high[k] - low[k]) for k in (0, 1))
    hit = np.zeros((n, n), int)
    for r in rings:
        for p, q in zip(r, np.roll(r, -1, axis=0)):
            over = (p[1] > y) != (q[1] > y)
            with np.errstate(divide="ignore", invalid="ignore"):
                at = p[0] + (y - p[1]) / (q[1] - p[1]) * (q[0] - p[0])
            hit += over[:, None] & (at[:, None] < x[None, :])
    return (hit % 2).sum() * np.prod((high - low) / n)


def test_areas_of_tangled_rings_are_those_of_the_even_odd_rule():
    rng = random.Random(4)
    for k in range(60):
        whole = k % 2
        at = (lambda: float(rng.randrange(12))) if whole else (lambda: rng.uniform(0, 12))
        rings = [np.array([(at(), at()) for _ in range(rng.randrange(3, 14))]) for _ in range(rng.choice([1, 1, 2]))]
        parts = polygons.repair(rings)
        errors = [abs(size(parts) - sampled(rings, n)) for n in (60, 480)]
        assert errors[1] < 0.6 and errors[1] <= errors[0] + 0.1
        again = [p for ring, holes in parts for p in polygons.repair([ring, *holes])]
        assert size(again) == pytest.approx(size(parts)) and len(again) == len(parts)
        for ring, holes in parts:
            assert all(len(np.unique(r, axis=0)) == len(r) for r in (ring, *holes))


def test_valid_rings_come_back_as_they_are():
    ring = np.array([(10 * math.cos(t) * (1 + 0.4 * math.sin(5 * t)), 10 * math.sin(t) * (1 + 0.4 * math.sin(5 * t))) for t in np.linspace(0, 2 * math.pi, 200, endpoint=False)])
    hole = np.array([(-1.0, -1.0), (1.0, -1.0), (0.0, 1.0)])
    for given in ([ring], [ring[::-1]], [ring, hole], [ring, hole[::-1]]):
        ((got, holes),) = polygons.repair(given)
        assert np.array_equal(got, given[0]) and all(np.array_equal(h, g) for h, g in zip(holes, given[1:])) and len(holes) == len(given) - 1


def test_bow_ties_spikes_double_rings_and_pinched_rings():
    area = lambda *rings: (len(p := polygons.repair([np.array(r, float) for r in rings])), round(size(p), 9), sum(len(h) for _, h in p))
    assert area([(0, 0), (2, 0), (0, 2), (2, 2)]) == (2, 2.0, 0)
    assert area([(0, 0), (4, 0), (4, 4), (2, 4), (2, 9), (2, 4), (0, 4)]) == (1, 16.0, 0)  # a spike
    square = [(0, 0), (3, 0), (3, 3), (0, 3)]
    assert area(square, square) == (0, 0, 0) and area([*square, *square]) == (0, 0, 0)
    assert area([(0, 0), (6, 0), (6, 6), (3, 6), (2, 3), (4, 3), (3, 6), (0, 6)]) == (1, 33.0, 1)  # a hole that hangs on the rim
    assert area(square, [(1, 1), (5, 1), (5, 2), (1, 2)]) == (2, 9 + 4 - 2 * 2.0, 0) or area(square, [(1, 1), (5, 1), (5, 2), (1, 2)])[1] == 9.0
    assert polygons.repair([]) == [] and area([(0, 0), (1, 1)]) == (0, 0, 0) and area([(0, 0), (1, 1), (2, 2)]) == (0, 0, 0)


def test_repaired_features(spark):
    rows = [("a", 1, [(0.0, 0.0), (2.0, 0.0), (0.0, 2.0), (2.0, 2.0)], None), ("a", 2, [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0)], [[(8.0, 1.0), (8.5, 1.0), (8.0, 2.0)]]), ("a", 3, [], None), ("a", 4, None, None)]
    df = spark.createDataFrame(rows, f"k string, id long, ring {RING}, holes array<{RING}>")
    got = polygons.repaired(df, ["k", "id"])
    assert got.columns == ["k", "id", "part", "ring", "holes"]
    assert sorted((r["id"], r["part"], len(r["ring"]), len(r["holes"])) for r in got.collect()) == [(1, 0, 3, 0), (1, 1, 3, 0), (2, 0, 3, 1)]
    assert polygons.repaired(df.limit(0), ["k", "id"]).count() == 0


def test_quadrangles_are_repaired_as_any_ring_without_its_steps():
    rng, known = random.Random(8), 0
    canon = lambda parts: sorted((min(tuple(map(tuple, np.roll(r, -k, axis=0).tolist())) for k in range(len(r))), len(h)) for r, h in parts)
    for _ in range(300):
        ring = np.array([(rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(4)])
        got = polygons.quadrangle(ring)
        known += got is not None
        assert got is None or canon(got) == canon(polygons.repair([ring]))
    assert known > 150 and polygons.quadrangle(np.array([(0, 0), (1, 0), (2, 0), (0, 1)], float)) is None
