"""Triangles and interpolation on made-up nodes."""

import numpy as np
import pytest

from soundgrid.operators import triangulation

PLACES = "id int, x double, y double"


@pytest.mark.parametrize("nodes", ["lattice", "random", "line"])
def test_triangles_tile_the_hull(nodes):
    rng = np.random.default_rng(3)
    x, y = {"lattice": np.divmod(np.arange(81), 9), "random": rng.uniform(0, 8, (2, 81)), "line": (np.arange(9), np.arange(9))}[nodes]
    x, y = np.asarray(x, float), np.asarray(y, float)
    tri = triangulation.triangles(x, y, 1e5)
    area = np.abs((x[tri[:, 1]] - x[tri[:, 0]]) * (y[tri[:, 2]] - y[tri[:, 0]]) - (x[tri[:, 2]] - x[tri[:, 0]]) * (y[tri[:, 1]] - y[tri[:, 0]])).sum() / 2
    assert (len(tri), area) == (128, pytest.approx(64)) if nodes == "lattice" else len(tri) == 0 if nodes == "line" else 50 < area < 64


@pytest.mark.parametrize("side", [32, 512])
def test_no_node_lies_in_any_circle_at_any_reach(side):
    """On dense lattices, with many nodes on one circle: by whole numbers, and the triangles fill the hull without gaps or overlaps."""
    rng = np.random.default_rng(side)
    for seed in range(12):
        places = np.unique(rng.integers(0, side, (250, 2)), axis=0) if seed else np.stack(np.divmod(np.arange(225), 15), axis=1) * (side // 16)
        x, y = places.T.astype(np.int64)
        for reach in (1e5, side / 4):
            tri = triangulation.triangles(x + 0.5, y + 0.5, reach)
            dx, dy = x[tri][:, :, None] - x, y[tri][:, :, None] - y
            area = lambda i, j: dx[:, i] * dy[:, j] - dx[:, j] * dy[:, i]  # noqa: E731, B023
            det = (x[tri[:, 1]] - x[tri[:, 0]]) * (y[tri[:, 2]] - y[tri[:, 0]]) - (y[tri[:, 1]] - y[tri[:, 0]]) * (x[tri[:, 2]] - x[tri[:, 0]])
            inner = np.sign(det)[:, None] * ((dx[:, 0] ** 2 + dy[:, 0] ** 2) * area(1, 2) + (dx[:, 1] ** 2 + dy[:, 1] ** 2) * area(2, 0) + (dx[:, 2] ** 2 + dy[:, 2] ** 2) * area(0, 1))
            assert (det != 0).all() and (inner <= 0).all()
            if reach == 1e5:
                edges = np.sort(np.concatenate([tri[:, [0, 1]], tri[:, [1, 2]], tri[:, [0, 2]]]), axis=1)
                times = np.unique(edges, axis=0, return_counts=True)[1]
                hull = int((times == 1).sum())
                assert times.max() == 2 and len(tri) == 2 * len(x) - 2 - hull
                whole = {tuple(t) for t in tri.tolist()}
                assert {tuple(t) for t in triangulation.triangles(x + 0.5, y + 0.5, side / 4).tolist()} <= whole


def test_triangles_do_not_depend_on_the_order_of_nodes_or_on_others_far_away():
    rng = np.random.default_rng(2)
    x, y = np.unique(rng.integers(0, 24, (200, 2)), axis=0).T.astype(float)
    named = lambda x, y, t: {tuple(sorted(zip(x[list(f)], y[list(f)]))) for f in t.tolist()}
    due = named(x, y, triangulation.triangles(x, y, 6.0))
    order = rng.permutation(len(x))
    assert named(x[order], y[order], triangulation.triangles(x[order], y[order], 6.0)) == due
    left = x < 14
    part = named(x[left], y[left], triangulation.triangles(x[left], y[left], 3.0))
    inner = lambda faces: {f for f in faces if max(p[0] for p in f) < 8}
    assert inner(part) == inner(named(x, y, triangulation.triangles(x, y, 3.0)))


def test_a_plane_is_met_in_every_block_and_blocks_do_not_show(spark):
    rng = np.random.default_rng(5)
    nodes = spark.createDataFrame([(float(a), float(b), float(2 * a - 3 * b + 1)) for a, b in rng.uniform(0, 60, (400, 2))], "x double, y double, v double")
    places = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.uniform(5, 55, (300, 2)))]
    found = {size: {r["id"]: r["value"] for r in triangulation.interpolate(spark.createDataFrame(places, PLACES), nodes, 10.0, size=size).collect()} for size in (20.0, 1000.0)}
    for i, a, b in places:
        assert found[20.0][i] == pytest.approx(2 * a - 3 * b + 1) == pytest.approx(found[1000.0][i])


def test_odd_nodes_and_places(spark):
    nodes = [(0.0, 0.0, 5.0), (0.0, 0.0, 1.0), (4.0, 0.0, 1.0), (0.0, 4.0, 1.0), (None, 1.0, 1.0), (1.0, 1.0, None), (100.0, 100.0, 9.0)]
    places = [(1, 1.0, 1.0), (2, 3.0, 3.0), (3, 50.0, 50.0), (4, None, 1.0), (1, 1.0, 1.0)]
    nodes, places = spark.createDataFrame(nodes, "x double, y double, v double"), spark.createDataFrame(places, PLACES)
    got = lambda **k: sorted(((r["id"], r["value"]) for r in triangulation.interpolate(places, nodes, 10.0, **k).collect()), key=lambda v: v[0])
    assert [(i, v and round(v, 9)) for i, v in got()] == [(1, 1.0), (1, 1.0), (2, None), (3, None), (4, None)]
    assert [v for _, v in got(near=1.0)] == [None] * 5
    assert triangulation.interpolate(places, nodes.limit(0), 10.0).filter("value is null").count() == 5
    assert triangulation.interpolate(places.limit(0), nodes, 10.0).count() == 0


def test_gate_without_water(spark):
    none = spark.createDataFrame([], "r int, c int, z double")
    row = triangulation.interpolation_gate(none, spark.createDataFrame([], "x double, y double, v double"), 10.0).collect()
    assert [tuple(r) for r in row] == [(0, 0, 0.0, 0.0, None)]
