"""Polygon partitions against brute force, and the refusals of registrations and indexes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from soundgrid.operators import partition, polygons
from soundgrid.sinks import tables
from soundgrid.sources import registry

RING = "array<struct<x: double, y: double>>"


def convex(rng, n=5, size=30.0):
    x, y, turn = rng.uniform(0, 100), rng.uniform(0, 100), rng.choice([1, -1])
    at = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [(x + size * math.cos(a), y + size * math.sin(a)) for a in at][::turn]


def area(points):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1]))) / 2


def inside(p, ring):
    d = [(b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) for a, b in zip(ring, ring[1:] + ring[:1])]
    return all(v >= -1e-9 for v in d) or all(v <= 1e-9 for v in d)


def common_area(a, b):
    """Of two convex rings: the corners of either inside the other and all crossings, in order around their middle."""
    points = [p for p in a if inside(p, b)] + [p for p in b if inside(p, a)]
    for p, q in zip(a, a[1:] + a[:1]):
        for r, s in zip(b, b[1:] + b[:1]):
            den = (q[0] - p[0]) * (s[1] - r[1]) - (q[1] - p[1]) * (s[0] - r[0])
            if abs(den) > 1e-12:
                t = ((r[0] - p[0]) * (s[1] - r[1]) - (r[1] - p[1]) * (s[0] - r[0])) / den
                u = ((r[0] - p[0]) * (q[1] - p[1]) - (r[1] - p[1]) * (q[0] - p[0])) / den
                if 0 <= t <= 1 and 0 <= u <= 1:
                    points.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
    if len(points) < 3:
        return 0.0
    mx, my = (sum(p[k] for p in points) / len(points) for k in (0, 1))
    return area(sorted(points, key=lambda p: math.atan2(p[1] - my, p[0] - mx)))


@pytest.fixture(scope="module")
def rings():
    rng = random.Random(7)
    return [(i, convex(rng)) for i in range(60)] + [(60, []), (61, None)]


def test_overlaps_of_convex_rings_agree_with_brute_force(spark, rings):
    df = spark.createDataFrame(rings, f"id long, ring {RING}")
    got = {(r["low"], r["high"]): r["area"] for r in partition.overlap_pairs(df, 17.0).collect()}
    full = [(i, r) for i, r in rings if r]
    due = {(i, j): v for i, a in full for j, b in full if i < j and (v := common_area(a, b)) > 1.0}
    assert len(due) > 100 and got.keys() == due.keys()
    assert all(abs(got[k] - due[k]) < 1e-6 for k in due)


def star(rng, cx, cy, n, low, high):
    """A ring that isn't convex: every point is seen from the middle."""
    return [(cx + r * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n)) for k in range(n) for r in [rng.uniform(low, high)]]


def holed(rng, cx, cy):
    """A concave ring with two concave holes, its middle first, as wedges with a sign: all from one point each."""
    ring, holes = star(rng, cx, cy, rng.randrange(5, 30), 14, 30), [star(rng, cx - 5, cy, 7, 1, 4)[::-1], star(rng, cx + 5, cy + 1, 9, 1, 4)]
    wedges = [(1, [(cx, cy), p, q]) for p, q in zip(ring, ring[1:] + ring[:1])]
    for (hx, hy), h in zip([(cx - 5, cy), (cx + 5, cy + 1)], holes):
        wedges += [(-1, [(hx, hy), p, q]) for p, q in zip(h, h[1:] + h[:1])]
    return ring, holes, wedges


def within(p, rings):
    hit = False
    for ring in rings:
        for a, b in zip(ring, ring[1:] + ring[:1]):
            if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (p[1] - a[1]) / (b[1] - a[1]) * (b[0] - a[0]):
                hit = not hit
    return hit


HOLED = f"id long, ring {RING}, holes array<{RING}>"


@pytest.fixture(scope="module")
def concave():
    rng = random.Random(19)
    return [(i, *holed(rng, rng.uniform(0, 100), rng.uniform(0, 100))) for i in range(14)]


def test_convex_parts_fill_a_concave_ring_with_holes_once(spark, concave):
    df = spark.createDataFrame([(i, r, h) for i, r, h, _ in concave], HOLED)
    for most in (8, 512):
        parts = polygons.convex_parts(df, ["id"], most).collect()
        for i, ring, holes, _ in concave:
            own = [[tuple(p) for p in r["ring"]] for r in parts if r["id"] == i]
            assert sum(map(area, own)) == pytest.approx(area(ring) - sum(map(area, holes)), rel=1e-9)
            rng = random.Random(i)
            for _ in range(200):
                p = (ring[0][0] + rng.uniform(-40, 40), ring[0][1] + rng.uniform(-40, 40))
                assert sum(inside(p, part) and area(part) > 1e-9 for part in own) == within(p, [ring, *holes])


def test_overlaps_of_concave_rings_with_holes_agree_with_brute_force(spark, concave):
    df = spark.createDataFrame([(i, r, h) for i, r, h, _ in concave] + [(90, [], []), (91, None, None)], HOLED)
    for cell in (9.0, 200.0):
        got = {(r["low"], r["high"]): (r["area"], r["width"]) for r in partition.overlap_pairs(df, cell).collect()}
        due = {}
        for i, ring, holes, a in concave:
            for j, other, inner, b in concave:
                if i < j and (v := sum(s * t * common_area(x, y) for s, x in a for t, y in b)) > 1.0:
                    due[i, j] = v
        assert len(due) > 10 and got.keys() == due.keys()
        for (i, j), v in due.items():
            assert got[i, j][0] == pytest.approx(v, abs=1e-6)
            rim, n = 0.0, 400
            one, two = ([concave[k][1], *concave[k][2]] for k in (i, j))
            for mine, theirs in ((one, two), (two, one)):
                for r in mine:
                    for p, q in zip(r, r[1:] + r[:1]):
                        rim += math.dist(p, q) * sum(within((p[0] + (k + 0.5) / n * (q[0] - p[0]), p[1] + (k + 0.5) / n * (q[1] - p[1])), theirs) for k in range(n)) / n
            assert got[i, j][1] == pytest.approx(2 * v / rim, rel=0.01)


def test_a_bar_over_an_l_and_equal_and_touching_rings(spark):
    bar = [(0.0, 0.0), (10.0, 0.0), (10.0, 3.0), (0.0, 3.0)]
    ell = [(6.0, 0.0), (12.0, 0.0), (12.0, 9.0), (9.0, 9.0), (9.0, 3.0), (6.0, 3.0)]
    slanted = [(0.0, 20.0), (7.0, 23.0), (3.0, 31.0)]
    beside = [(7.0, 23.0), (0.0, 20.0), (5.0, 11.0)]
    df = spark.createDataFrame([(1, bar), (2, ell), (3, slanted), (4, slanted[::-1]), (5, beside)], f"id long, ring {RING}")
    got = {(r["low"], r["high"]): (round(r["area"], 9), round(r["width"], 9)) for r in partition.overlap_pairs(df, 4.0, least_area=1e-9).collect()}
    rim = sum(math.dist(p, q) for p, q in zip(slanted, slanted[1:] + slanted[:1]))
    assert got == {(1, 2): (12.0, round(24 / 14, 9)), (3, 4): (round(area(slanted), 9), round(2 * area(slanted) / rim, 9))}


def test_churn_and_routes_over_concave_rings_with_holes(spark, concave):
    (i, ring, holes, wedges), moved = concave[0], lambda points: [(x + 3.0, y - 1.0) for x, y in points]
    frame = lambda r, h: spark.createDataFrame([(i, "x", r, h)], f"id long, band string, ring {RING}, holes array<{RING}>")
    churn = partition.gate_displacement(frame(ring, holes), frame(moved(ring), [moved(h) for h in holes]), ["band"], 11.0, 0.01).first()["churn"]
    own = area(ring) - sum(map(area, holes))
    assert churn == pytest.approx(2 * own - 2 * sum(s * t * common_area(a, moved(b)) for s, a in wedges for t, b in wedges), abs=1e-6)
    rng = random.Random(4)
    routes = [(f"r{k}", *(rng.uniform(0, 100) for _ in range(4)), 0.0) for k in range(12)]
    deep = spark.createDataFrame([(1.0, r, h) for _, r, h, _ in concave], f"deep double, ring {RING}, holes array<{RING}>")
    got = {r["route"]: r["share"] for r in partition.covered_routes(spark.createDataFrame(routes, "route string, ax double, ay double, bx double, by double, need double"), deep, 17.0).collect()}
    for name, ax, ay, bx, by, _ in routes:
        n = 4000
        hit = sum(any(within((ax + (k + 0.5) / n * (bx - ax), ay + (k + 0.5) / n * (by - ay)), [r, *h]) for _, r, h, _ in concave) for k in range(n)) / n
        assert abs(got[name] - hit) < 0.005


def test_overlaps_meet_by_equality(spark, rings):
    df = spark.createDataFrame(rings, f"id long, ring {RING}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = partition.overlap_pairs(df, 17.0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_union_of_parts_has_no_inner_edges_and_tells_repeated_parts(spark):
    square = lambda x, y: [(x, y), (x + 1.0, y), (x + 1.0, y + 1.0), (x, y + 1.0)]
    rows = [("a", i, square(float(i), 0.0)[:: 1 if i % 2 else -1]) for i in range(4)] + [("b", 9, square(0.0, 0.0)), ("b", 10, square(0.0, 0.0)), ("c", 11, [(0.0, 0.0), (4.0, 0.0), (0.0, 3.0)])]
    df = spark.createDataFrame(rows, f"k string, id long, ring {RING}")
    got = {r["k"]: (r["parts"], r["edges"], r["rim"], r["area"], r["identity"]) for r in partition.coverage_union(df, ["k"]).collect()}
    assert got == {"a": (4, 10, 10.0, 4.0, True), "b": (2, 4, 4.0, 1.0, False), "c": (1, 3, 12.0, 6.0, True)}


def test_covered_shares_of_slanted_routes_agree_with_sampling(spark, rings):
    rng = random.Random(3)
    routes = [(f"r{i}", *(rng.uniform(0, 100) for _ in range(4)), float(i % 3)) for i in range(12)]
    deep = [(float(i % 4), r) for i, r in rings]
    got = {r["route"]: r["share"] for r in partition.covered_routes(spark.createDataFrame(routes, "route string, ax double, ay double, bx double, by double, need double"), spark.createDataFrame(deep, f"deep double, ring {RING}"), 17.0).collect()}
    for name, ax, ay, bx, by, need in routes:
        use, n = [r for d, r in deep if r and d >= need], 4000
        hit = sum(any(inside((ax + (k + 0.5) / n * (bx - ax), ay + (k + 0.5) / n * (by - ay)), r) for r in use) for k in range(n)) / n
        assert abs(got[name] - hit) < 0.005


def test_churn_of_moved_convex_parts(spark, rings):
    full = [(i, "x", r) for i, r in rings if r][:1]
    moved = [(i, k, [(x + 2.0, y) for x, y in r]) for i, k, r in full]
    frame = lambda rows: spark.createDataFrame(rows, f"id long, band string, ring {RING}")
    got = partition.gate_displacement(frame(full), frame(moved), ["band"], 17.0, 0.01).first()
    assert abs(got["churn"] - (2 * area(full[0][2]) - 2 * common_area(full[0][2], moved[0][2]))) < 1e-6 and got["wrong"] == "moved"
    assert partition.gate_displacement(frame(full), frame(full), ["band"], 17.0, 0.0).first()["churn"] == pytest.approx(0.0, abs=1e-6)


def test_empty_partitions(spark):
    none = spark.createDataFrame([], f"id long, band string, ring {RING}")
    assert partition.overlap_pairs(none, 5.0).count() == partition.coverage_union(none, ["band"]).count() == partition.gate_partition(none, none, ["band"], 5.0, 1.0).count() == partition.gate_displacement(none, none, ["band"], 5.0, 1.0).count() == 0


def test_broken_files_take_their_cell_or_refuse_the_source(spark):
    schema = "source string, key string, cell string, value long"
    before = spark.createDataFrame([("s", "old1", "c1", 1), ("s", "same", "c2", 2)], schema)
    now = [("s", "same", "c2", None), ("s", "new", "c3", 3), ("s", "new1", "c1", None), ("s", "lost", "c9", None)]
    rows = {r["key"]: (r["registered"], r["value"], r["origin"], r["healthy"], r["refused"]) for r in registry.register_raw(spark.createDataFrame(now, schema), before).collect()}
    assert rows == {"same": ("same", 2, "kept", True, False), "new": ("new", 3, "read", True, False), "new1": ("old1", 1, "carried", False, False)}
    many = now + [("s", f"bad{i}", None, None) for i in range(4)]
    assert {r["refused"] for r in registry.register_raw(spark.createDataFrame(many, schema), before).collect()} == {True}


def test_globs_of_a_column_are_those_of_a_pattern(spark):
    globs = ["*.tif", "a?c|*+(x).z[1]", "data/*/v1.*"]
    paths = ["b.tif", "btif", "abc", "abbc", "q+(x).z[1]", "data/q/v1.csv", "data/q/v1csv"]
    df = spark.createDataFrame([(g, p) for g in globs for p in paths], "g string, p string")
    found = {(r["g"], r["p"]) for r in df.filter(F.regexp_like("p", registry.glob_column(F.col("g")))).collect()}
    due = {(g, r["p"]) for g in globs for r in registry.glob_filter(df.filter(F.col("g") == g), "p", g).collect()}
    assert found == due and len(due) == 4


def test_an_index_with_a_missing_tile_is_refused(spark, tmp_path):
    tiled = spark.createDataFrame([("t1", "a"), ("t1", "b"), ("t2", "a")], "stem string, source string")
    ranks = spark.createDataFrame([("b", 4)], "source string, priority int")
    there = spark.createDataFrame([("t1", "x/t1"), ("t2", "x/t2")], "stem string, location string")
    with pytest.raises(ValueError, match="t2"):
        tables.write_index(tables.mosaic_index(tiled, there.filter("stem = 't1'"), ranks), str(tmp_path / "index"))
    whole = tables.mosaic_index(tiled, there, ranks)
    assert tables.write_index(whole, str(tmp_path / "index")) and not tables.write_index(whole, str(tmp_path / "index"))
    assert [tuple(r) for r in tables.read_latest(spark, str(tmp_path / "index")).orderBy("stem").collect()] == [("t1", "x/t1", "a,b", 4), ("t2", "x/t2", "a", 0)]


def test_rings_are_halved_until_they_are_short(spark):
    n = 200
    rows = [(1, [(40 * math.cos(2 * math.pi * k / n), 9 * math.sin(2 * math.pi * k / n)) for k in range(n)]), (2, [(0.0, 0.0), (3.0, 0.0), (3.0, 3.0), (2.0, 3.0), (2.0, 1.0), (1.0, 1.0), (1.0, 3.0), (0.0, 3.0)]), (3, [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]), (4, [])]
    got: dict[int, list] = {}
    for r in partition.subdivided(spark.createDataFrame(rows, f"id long, ring {RING}"), 20).collect():
        got.setdefault(r["id"], []).append([tuple(p) for p in r["ring"]])
    assert len(got[1]) > 9 and all(len(r) <= 20 for own in got.values() for r in own)
    assert all(abs(sum(map(area, got[i])) - area(r)) < 1e-9 for i, r in rows[:3]) and got[3] == [rows[2][1]] and got[4] == [[]]


def test_neighbours_keep_one_line_when_simplified(spark):
    rng = random.Random(11)
    line = [(50 + rng.uniform(-1, 1), float(y)) for y in range(1, 100)]
    left = [(0.0, 0.0), (50.0, 0.0), *line, (50.0, 100.0), (0.0, 100.0)]
    right = [(100.0, 0.0), (100.0, 100.0), (50.0, 100.0), *line[::-1], (50.0, 0.0)]
    island = [(200 + 10 * math.cos(2 * math.pi * k / 90), 10 * math.sin(2 * math.pi * k / 90)) for k in range(90)]
    rows = [("a", 1, left), ("a", 2, right), ("a", 3, island), ("b", 4, [(0.0, 0.0), (0.1, 0.0), (0.0, 0.1)]), ("c", 5, [])]
    got = {r["id"]: ([tuple(p) for p in r["ring"]], r["simplified"]) for r in partition.coverage_simplify(spark.createDataFrame(rows, f"k string, id long, ring {RING}"), ["k"], 0.8, 0.01).collect()}
    on_line = [[p for p in got[i][0] if p in set(line)] for i in (1, 2)]
    assert on_line[0] == on_line[1][::-1] and 0 < len(on_line[0]) < len(line)
    # By hand: of the whole line with its ends, the smallest triangle goes first.
    rest = [(50.0, 0.0), *line, (50.0, 100.0)]
    size = lambda i: abs((rest[i][0] - rest[i - 1][0]) * (rest[i + 1][1] - rest[i - 1][1]) - (rest[i + 1][0] - rest[i - 1][0]) * (rest[i][1] - rest[i - 1][1])) / 2
    while (v := min((size(i), rest[i], i) for i in range(1, len(rest) - 1)))[0] < 0.64:
        rest.pop(v[2])
    assert on_line[0] == rest[1:-1]
    assert got[1][1] and 3 < len(got[3][0]) < 90 and abs(sum(area(got[i][0]) for i in (1, 2)) - 10000) < 1e-6
    assert len(got[4][0]) == 3 and got[5] == ([], False)


def test_cut_features_are_never_broadcast(spark, rings):
    df = spark.createDataFrame(rings, f"id long, ring {RING}")
    plan = partition.overlap_pairs(df, 17.0)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_areas_and_parts_of_batches_are_those_of_each_polygon():
    import numpy as np

    from soundgrid.operators import polygons

    half = np.array([[[0.0, 0.0], [2.0, 0.0], [0.0, 2.0], [0.0, 2.0]]] * 2)
    box = np.array([[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0]], [[2.0, 0.0], [3.0, 0.0], [3.0, 1.0], [2.0, 1.0]]])
    assert polygons.shared_areas(half, box).tolist() == [1.0, 0.0]
    shapes = [np.array([(0, 0), (4, 0), (4, 3), (2, 1), (0, 3)], float), np.array([(1, 1), (2, 5), (0, 2)], float)]
    a, b = np.concatenate(shapes), np.concatenate([np.roll(r, -1, axis=0) for r in shapes])
    parts, owner = polygons.trapezoids_of(a, b, np.repeat([0, 1], [5, 3]))
    for k, r in enumerate(shapes):
        assert sorted(map(str, parts[owner == k].tolist())) == sorted(map(str, polygons.trapezoids([r]).tolist()))


def test_features_are_cut_once_and_lie_in_the_bins_that_they_share_ground_with(spark, monkeypatch):
    made, own = [], partition.convex_parts
    monkeypatch.setattr(partition, "convex_parts", lambda *args, **more: made.append(1) or own(*args, **more))
    box = lambda i, x, y, w: (i, [{"x": x + dx * w, "y": y + dy * w} for dx, dy in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0))])
    df = spark.createDataFrame([box(1, 0.0, 0.0, 5.0), box(2, 5.0, 0.0, 5.0), box(3, 0.0, 0.0, 10.0), box(4, -5.0, -5.0, 5.0), box(5, -7.0, 3.0, 8.5)], "id long, ring array<struct<x: double, y: double>>")
    found = {(r["low"], r["high"], r["area"]) for r in partition.overlap_pairs(df, 5.0).collect()}
    assert found == {(1, 3, 25.0), (2, 3, 25.0), (1, 5, 3.0), (3, 5, 10.5)} and len(made) == 1
    parts = own(df, ["id"], boxed=True)
    assert {r["id"]: r["count"] for r in partition._binned(parts, 5.0, True).groupBy("id").count().collect()} == {1: 1, 2: 1, 3: 4, 4: 1, 5: 9}
