"""Operators on hand-made grids and against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from soundgrid.functions import depth, tiles
from soundgrid.operators import covering, datum, focal, intervals, labels, merge, near, ordered, serving, vectors
from soundgrid.sinks import tables
from soundgrid.sources import formats, registry
from soundgrid.streaming import incremental


def grid(spark, rows):
    """A grid from rows of numbers; None is no data."""
    return spark.createDataFrame([(r, c, None if z is None else float(z)) for r, row in enumerate(rows) for c, z in enumerate(row)], "r int, c int, z double")


def noise(seed, n, share=0.5):
    rng = random.Random(seed)
    return [(r, c) for r in range(n) for c in range(n) if rng.random() < share]


def flood(cells, diagonal):
    cells, label = set(cells), {}
    for start in sorted(cells):
        if start in label:
            continue
        label[start], stack = start, [start]
        while stack:
            r, c = stack.pop()
            for dr in (-1, 0, 1):
                for dc in (-1, 0, 1):
                    p = (r + dr, c + dc)
                    if (dr or dc) and (diagonal or not (dr and dc)) and p in cells and p not in label:
                        label[p] = start
                        stack.append(p)
    return label


@pytest.mark.parametrize("diagonal", [False, True])
@pytest.mark.parametrize("share", [0.4, 0.6])
def test_components_are_those_of_a_flood(spark, diagonal, share):
    cells = noise(7, 30, share)
    got = {(r["r"], r["c"]): r["label"] for r in labels.label_components(spark.createDataFrame(cells, "r int, c int"), diagonal).collect()}
    truth = flood(cells, diagonal)
    assert got.keys() == truth.keys()
    assert len(set(got.values())) == len(set(truth.values()))
    assert len({(got[p], truth[p]) for p in got}) == len(set(truth.values()))


def test_corners_join_only_with_diagonals(spark):
    pixels = spark.createDataFrame([(0, 0), (1, 1)], "r int, c int")
    assert labels.label_components(pixels).select("label").distinct().count() == 2
    assert labels.label_components(pixels, diagonal=True).select("label").distinct().count() == 1
    assert labels.label_components(pixels.limit(0)).count() == 0


def test_a_long_row_is_one_component(spark):
    pixels = spark.range(5000).select(F.lit(0).alias("r"), F.col("id").cast("int").alias("c"))
    assert labels.label_components(pixels).select("label").distinct().count() == 1


def test_ponds_fill_to_their_rim_and_only_if_closed(spark):
    rows = [[3.0] * 9 for _ in range(9)]
    rows[2][2] = -1.0
    rows[5][5], rows[5][6] = -1.5, -0.5
    rows[0][8] = -1.0  # on the grid's edge
    rows[7][1] = -5.0  # too deep
    rows[7][7], rows[7][8] = -1.0, None
    out = {(r["r"], r["c"]): r["z"] for r in labels.pond_fill(grid(spark, rows), 4, 3.0).collect()}
    assert out[2, 2] == 3.0 and out[5, 5] == 3.0 and out[5, 6] == 3.0
    assert out[0, 8] == -1.0 and out[7, 1] == -5.0 and out[7, 7] == -1.0 and out[7, 8] is None


def test_an_enclosed_shoal_is_found_once_at_its_least_level(spark):
    rows = [[-30.0] * 9 for _ in range(9)]
    for r in range(2, 6):
        for c in range(2, 6):
            rows[r][c] = -8.0
    rows[3][4] = -3.0
    rows[8][8] = -1.0  # open to the edge
    edge = (F.col("r") % 8 == 0) | (F.col("c") % 8 == 0)
    out = labels.enclosed_shoals(grid(spark, rows), [5.0, 10.0, 20.0], edge).collect()
    assert [(r["r"], r["c"], r["depth"], r["level"]) for r in out] == [(3, 4, 3.0, 5.0)]


def test_a_lone_rock_in_deep_water_is_a_dome(spark):
    rows = [[-20.0] * 16 for _ in range(16)]
    rows[3][3], rows[3][4], rows[4][3] = 1.0, 2.0, -1.0  # a shallow pixel beside it is not in the frame two pixels off
    rows[10][10], rows[10][12] = 1.0, -1.0  # shallow in the frame
    rows[14][14] = 3.0  # its frame leaves the raster
    rows[10][3] = 0.5
    for r, c in [(8, c) for c in range(1, 6)] + [(12, c) for c in range(1, 6)]:
        rows[r][c] = None  # over half of its frame is missing
    out = labels.dome_candidates(grid(spark, rows), 4, 2, (0, 0, 15, 15)).collect()
    assert [(r["pixels"], r["high"], r["rim_high"]) for r in out] == [(2, 2.0, -20.0)]


def test_reducing_keeps_shoals_and_nests(spark):
    rng = random.Random(3)
    rows = [[rng.choice([None, -30.0, -2.0, 5.0, 40.0]) for _ in range(16)] for _ in range(16)]
    pixels = grid(spark, rows)
    once = {(r["r"], r["c"]): r["z"] for r in merge.shoal_reduce(pixels, 2).collect()}
    twice = {(r["r"], r["c"]): r["z"] for r in merge.shoal_reduce(merge.shoal_reduce(pixels)).collect()}
    assert once == twice
    for (r, c), z in once.items():
        own = [rows[i][j] for i in range(4 * r, 4 * r + 4) for j in range(4 * c, 4 * c + 4) if rows[i][j] is not None]
        low = [v for v in own if v <= 16]
        assert z == (max(low) if low else max(own, default=None))


@pytest.mark.parametrize("zoom", [0, 8, 12, 15, 19])
def test_quantizing_never_deepens_and_water_stays_water(spark, zoom):
    rng = random.Random(zoom)
    rows = [(rng.uniform(-10000, 100),) for _ in range(500)] + [(rng.uniform(-3, 0.1),) for _ in range(500)] + [(0.0,), (-0.002,), (None,)]
    out = spark.createDataFrame(rows, "z double").select("z", depth.quantize(F.col("z"), zoom).alias("q"))
    r, g, b = depth.terrarium_encode(F.col("q"))
    for row in out.withColumn("back", depth.terrarium_decode(r, g, b)).collect():
        if row["z"] is None:
            assert row["q"] is None
            continue
        assert row["q"] >= row["z"] or -depth.LSB < row["z"] < 0
        assert (row["q"] < 0) == (row["z"] < 0) and row["back"] == row["q"]


def blur(a, sigma, mode):
    """A whole array's Gaussian, with every tap of both directions at once."""
    n = int(4 * sigma + 0.5)
    taps = np.exp(-0.5 * (np.arange(-n, n + 1) / sigma) ** 2)
    wide = np.pad(a, n, mode=mode)
    rows = np.stack([(wide[i : i + 2 * n + 1] * taps[:, None]).sum(axis=0) for i in range(a.shape[0])])
    return np.stack([(rows[:, j : j + 2 * n + 1] * taps).sum(axis=1) for j in range(a.shape[1])], axis=1) / taps.sum() ** 2


def relief(seed, side, holes=0.1):
    rng = np.random.default_rng(seed)
    z = blur(rng.normal(size=(side, side)), 3.0, "wrap") * 900 - 60
    return np.where(rng.random((side, side)) < holes, np.nan, z)


def pixels_of(spark, z, **more):
    rows = [(i, j, None if np.isnan(z[i, j]) else float(z[i, j]), *(v[i][j] for v in more.values())) for i in range(len(z)) for j in range(len(z[0]))]
    return spark.createDataFrame(rows, "r int, c int, z double" + "".join(f", {k} string" for k in more))


def array_of(rows, value, shape):
    out = np.full(shape, np.nan)
    for r in rows:
        out[r["r"], r["c"]] = np.nan if r[value] is None else r[value]
    return out


@pytest.mark.parametrize("sigmas", [(1.0, 2.0, 1.0), (4.0, 16.0, 4.0)])
def test_smoothing_in_blocks_is_that_of_the_whole_and_never_deepens(spark, sigmas):
    z = relief(5, 90)
    light, heavy, feather = sigmas
    got = array_of(focal.smooth_shoalward(pixels_of(spark, z), 400.0, (0, 0, 89, 89), light, heavy, feather, size=37).collect(), "smoothed", z.shape)
    work = np.where(z < 0, z, 0.0)
    gy, gx = np.gradient(work, 400.0)
    weight = blur(1 - np.clip((np.degrees(np.arctan(np.hypot(gx, gy))) - 1) / 4, 0, 1), feather, "edge")
    share = np.clip((-work - 30) / 170, 0, 1)
    mixed = z * (1 - weight) + (blur(work, light, "edge") * (1 - share) + blur(work, heavy, "edge") * share) * weight
    expected = np.where(z < 0, np.maximum(mixed, z), z)
    assert np.allclose(got, expected, rtol=0, atol=1e-9, equal_nan=True) and np.nanmax(np.abs(got - z)) > 1
    assert (got[z < 0] >= z[z < 0]).all() and np.array_equal(got[z >= 0], z[z >= 0])
    means = array_of(focal.water_blur(pixels_of(spark, z), heavy, (0, 0, 89, 89), size=37).collect(), "mean", z.shape)
    assert np.allclose(means, blur(work, heavy, "edge"), rtol=0, atol=1e-9)


def test_distances_and_fills_in_blocks(spark):
    z = relief(6, 40, holes=0.93)
    valid = [(i, j) for i in range(40) for j in range(40) if not np.isnan(z[i, j])]
    expected, filled = np.full(z.shape, np.nan), z.copy()
    for i in range(40):
        for j in range(40):
            d2, a, b = min(((i - a) ** 2 + (j - b) ** 2, a, b) for a, b in valid)
            if d2 <= 36:
                expected[i, j] = d2**0.5
                filled[i, j] = z[a, b]
    pixels = pixels_of(spark, z)
    assert np.allclose(array_of(focal.distance_to(pixels, F.col("z").isNotNull(), 6, size=11).collect(), "distance", z.shape), expected, equal_nan=True)
    assert np.array_equal(array_of(focal.nearest_fill(pixels, 6, size=11).collect(), "filled", z.shape), filled, equal_nan=True)


def test_feathering_is_that_of_the_layers(spark):
    """Against the rule itself, layer by layer: the rims of what is covered so far, without the whole cover's own rim."""
    rng = np.random.default_rng(9)
    coarse = rng.integers(1, 5, (8, 8)).repeat(10, 0).repeat(10, 1)  # 4 is missing
    z = np.where(coarse < 4, relief(7, 80, 0) + 55 + 4 * coarse, np.nan)

    def shrunk(a):
        wide = np.pad(a, 1)
        return a & wide[:-2, 1:-1] & wide[2:, 1:-1] & wide[1:-1, :-2] & wide[1:-1, 2:]

    rims = np.zeros(z.shape, bool)
    for k in (1, 2, 3):
        rims |= (coarse <= k) & ~shrunk(coarse <= k)
    rims &= shrunk(coarse < 4)
    t = np.clip(blur(rims.astype(float), 2.0, "symmetric") * np.sqrt(2 * np.pi) * 2, 0, 1)
    t = 3 * t**2 - 2 * t**3
    whole = np.nan_to_num(z)
    mixed = t * blur(whole, 2.0, "symmetric") + (1 - t) * whole
    expected = np.where(np.isnan(z), np.nan, np.where((whole >= 0) & (mixed < 0), whole, mixed))
    there = pixels_of(spark, z, src=coarse.astype(str).tolist()).filter("z is not null")
    got = array_of(focal.seam_feather(there, F.col("src").cast("int"), (0, 0, 79, 79), size=33).collect(), "feathered", z.shape)
    assert np.allclose(got, expected, rtol=0, atol=1e-9, equal_nan=True) and rims.sum() > 100 and np.nanmax(np.abs(got - z)) > 1


def test_labels_floor_to_what_is_charted(spark):
    m, ft, fm = depth.depth_labels(F.col("d"))
    rows = spark.createDataFrame([(0.3,), (1.2192,), (20.99,), (21.4,), (30.6,), (31.9,)], "d double").select(m.alias("m"), ft.alias("ft"), fm.alias("fm")).collect()
    assert [r["m"] for r in rows] == [0.3, 1.2, 20.9, 21.0, 30.5, 31.0] and rows[1]["ft"] == 4


def test_hilbert_numbers_walk_from_neighbour_to_neighbour(spark):
    cells = spark.range(256).select((F.col("id") % 16).alias("x"), F.floor(F.col("id") / 16).alias("y"))
    walk = [(r["x"], r["y"]) for r in cells.withColumn("d", tiles.hilbert_id(4, F.col("x"), F.col("y"))).orderBy("d").collect()]
    assert len(set(walk)) == 256 and walk[0] == (0, 0) and walk[-1] == (15, 0)
    assert all(abs(a - c) + abs(b - d) == 1 for (a, b), (c, d) in zip(walk, walk[1:]))


def test_even_odd_rings_leave_holes(spark):
    outer = [(0.0, 0.0), (6.0, 0.0), (6.0, 6.0), (0.0, 6.0)]
    bow = [(10.0, 0.0), (14.0, 4.0), (14.0, 0.0), (10.0, 4.0)]
    feature = spark.createDataFrame([(1, outer), (2, bow)], "id int, ring array<struct<x: double, y: double>>")
    got = {(r["id"], r["r"], r["c"]) for r in vectors.rasterize(feature, 8).collect()}
    assert {g for g in got if g[0] == 1} == {(1, r, c) for r in range(6) for c in range(6)}

    def inside(ring, x, y):
        odd = False
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (ay > y) != (by > y) and x < ax + (y - ay) / (by - ay) * (bx - ax):
                odd = not odd
        return odd

    assert {g for g in got if g[0] == 2} == {(2, r, c) for r in range(8) for c in range(16) if inside(bow, c + 0.5, r + 0.5)}


def test_adjacent_tiles_of_different_zooms_and_over_the_antimeridian(spark):
    stems = spark.createDataFrame([("a", 1, 0, 0), ("b", 1, 1, 0), ("c", 2, 2, 1), ("d", 2, 0, 2)], "stem string, z int, x int, y int")
    got = {tuple(r) for r in vectors.seam_adjacency(stems).collect()}
    assert {("a", "b", "east"), ("b", "a", "east"), ("a", "c", "east"), ("a", "d", "south")} <= got
    assert ("c", "a", "east") not in got


def test_intervals_against_sets_of_points(spark):
    rng = random.Random(2)
    spans = lambda n: [(k % 3, a, a + rng.randrange(1, 9)) for k in range(n) for a in [rng.randrange(60)]]
    a, b = spans(30), spans(30)
    cells = lambda rows: {(k, p) for k, lo, hi in rows for p in range(lo, hi)}
    da, db = (spark.createDataFrame(x, "k int, lo int, hi int") for x in (a, b))
    rows = lambda df: cells((r["k"], r["lo"], r["hi"]) for r in df.collect())
    assert rows(intervals.interval_union(da, ["k"])) == cells(a)
    assert rows(intervals.interval_intersect(da, db, ["k"])) == cells(a) & cells(b)
    assert rows(intervals.interval_difference(da, db, ["k"])) == cells(a) ^ cells(b)


def test_nearest_neighbours_of_crowded_and_lonely_points(spark):
    """Half of all points in one small part of a cell, repeated places, points without others near; few places a cell, so several levels."""
    rng = random.Random(31)
    pts = [(i, 50 + rng.random() * 0.01, 50 + rng.random() * 0.01) for i in range(300)] + [(300 + i, rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(250)]
    pts += [(600 + i, 20.0, 20.0) for i in range(5)] + [(700, 50.004, 50.004), (701, 50.004, 50.004), (702, None, 1.0), (703, 1e6, 1e6)]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    got = {r["id"]: (r["near_id"], round(r["distance"], 12)) for r in near.nearest_neighbour(df, df, 9.0, most=16).collect()}
    due = {}
    full = [p for p in pts if p[1] is not None]
    for i, x, y in full:
        best = min((math.hypot(x - u, y - v), j) for j, u, v in full if j != i)
        if best[0] <= 9.0:
            due[i] = (best[1], round(best[0], 12))
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in due.items()} and sum(got[k] != due[k] for k in due) == 0
    assert near.nearest_neighbour(df, df.limit(0), 9.0).count() == 0 == near.nearest_neighbour(df.limit(0), df, 9.0).count()


def test_nearest_neighbours_within_reach(spark):
    rng = random.Random(9)
    pts = [(i, rng.uniform(0, 50), rng.uniform(0, 50)) for i in range(200)]
    got = {r["id"]: (r["near_id"], r["distance"]) for r in near.nearest_neighbour(*(spark.createDataFrame(pts, "id int, x double, y double"),) * 2, 4.0).collect()}
    for i, x, y in pts:
        d, j = min((((x - u) ** 2 + (y - v) ** 2) ** 0.5, j) for j, u, v in pts if j != i)
        assert (i in got) == (d <= 4.0) and (d > 4.0 or got[i][0] == j)


def test_writes_only_what_changed_and_the_pointer_last(spark, tmp_path):
    path = str(tmp_path / "out")
    a, b = spark.range(10), spark.range(11)
    assert tables.write_if_changed(a, path) and not tables.write_if_changed(a.orderBy(F.desc("id")), path)
    assert tables.write_if_changed(b, path) and tables.read_latest(spark, path).count() == 11
    assert tables.read_latest(spark, str(tmp_path / "none")) is None


def test_nothing_is_collected_while_a_reference_is_missing(spark):
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "k string")
    assert [tuple(r) for r in tables.unreferenced(names("a", "b"), names("a"), "k").collect()] == [("b", False)]
    assert [tuple(r) for r in tables.unreferenced(names("a", "b"), names("a", "z"), "k").collect()] == [("b", True)]


def test_patterns_and_specs(spark):
    assert registry.glob_pattern("*.TIF|a?b") == r"^(?:.*\.tif|a.b)$"
    rows = spark.createDataFrame([("# c\n",), ("1 2 3",), ("4,5,6",), ("0 0 0",), ("",)], "value string")
    assert [tuple(r) for r in formats.points(rows).collect()] == [(1.0, 2.0, 3.0), (4.0, 5.0, 6.0)]


def test_a_stream_of_changes_rebuilds_what_it_touched(spark, tmp_path):
    source, seen = str(tmp_path / "changes"), []
    spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "tile int, v int").write.parquet(source)
    stream = spark.readStream.schema("tile int, v int").parquet(source)
    incremental.rebuild_changed(stream, ["tile"], lambda keys, n: seen.append(sorted(r["tile"] for r in keys.collect())), str(tmp_path / "state")).awaitTermination()
    assert seen == [[1, 2]]
    spark.createDataFrame([(7, 1)], "tile int, v int").write.mode("append").parquet(source)
    stream = spark.readStream.schema("tile int, v int").parquet(source)
    incremental.rebuild_changed(stream, ["tile"], lambda keys, n: seen.append(sorted(r["tile"] for r in keys.collect())), str(tmp_path / "state")).awaitTermination()
    assert seen[-1] == [7]


def test_a_windowed_stream_agrees_with_its_batch(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    source = str(tmp_path / "events")
    events.write.parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    run = incremental.windowed_counts(stream, "ts", "event_type").writeStream.outputMode("complete").format("memory").queryName("windowed").trigger(availableNow=True).start()
    run.awaitTermination()
    batch = incremental.windowed_counts(events, "ts", "event_type").select("start", "event_type", "n")
    live = spark.sql("SELECT start, event_type, n FROM windowed")
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, live.collect()))


def test_clipping_keeps_the_area_inside(spark):
    triangle = [(0.0, 0.0), (8.0, 0.0), (0.0, 8.0)]
    rows = spark.createDataFrame([(1, triangle), (2, [(20.0, 20.0), (21.0, 20.0), (21.0, 21.0)])], "id int, ring array<struct<x: double, y: double>>")
    cut = rows.select("id", vectors.clip_box(F.col("ring"), 1.0, 1.0, 5.0, 9.0).alias("ring"))
    got = {r["id"]: r["a"] for r in cut.select("id", vectors.ring_area(F.col("ring")).alias("a")).collect()}
    assert got[1] == pytest.approx(16.0) and got[2] == 0.0


def test_sorted_lists_match_greedily(spark):
    a = spark.createDataFrame([("s", 1.0), ("s", 5.0), ("s", 9.0), ("t", 1.0)], "k string, p double")
    b = spark.createDataFrame([("s", 1.4), ("s", 8.9), ("u", 2.0)], "k string, p double")
    got = {(r["k"], r["pa"], r["pb"]) for r in ordered.match_sorted(a, b, ["k"], 0.5).collect()}
    assert got == {("s", 1.0, 1.4), ("s", 5.0, None), ("s", 9.0, 8.9), ("t", 1.0, None), ("u", None, 2.0)}


def test_batches_hold_whole_groups_under_the_limit(spark):
    rows = [("a", f"g{i:02}", s) for i, s in enumerate([4, 4, 4, 12, 1, 1])]
    got = [r["batch"] for r in ordered.plan_batches(spark.createDataFrame(rows, "source string, name string, size long"), ["source"], 10).orderBy("name").collect()]
    assert got == [0, 0, 1, 2, 3, 3]


def test_heavy_and_light_tiles_alternate(spark):
    rows = spark.createDataFrame([(f"t{k}", k) for k in range(10)], "stem string, weight int")
    order = [r["weight"] for r in ordered.tile_priority(rows).orderBy("place").collect()]
    assert sorted(order) == list(range(10)) and order[:4] == [9, 0, 8, 1]


def test_tiles_keep_to_the_average_weight(spark):
    rng = random.Random(4)
    cases = [[10] * 3 + [1] * 27, [5] * 7, [1], [3, 3, 3, 0], [rng.choice([0, 1, 1, 1, 2, 40]) for _ in range(300)], [rng.choice([1, 9, 9, 9, 8]) for _ in range(211)], [rng.randrange(-5, 12) for _ in range(150)]]
    for weights in cases:
        left, order, total = sorted(weights, reverse=True), [], 0
        for i in range(len(weights)):
            order.append(left.pop(0 if total * len(weights) <= i * sum(weights) else -1))
            total += order[-1]
        rows = spark.createDataFrame([(f"t{k}", w) for k, w in enumerate(weights)], "stem string, weight int")
        got = ordered.tile_priority(rows, ranks=16).orderBy("place").collect()
        assert [r["place"] for r in got] == list(range(1, len(weights) + 1)) and [r["weight"] for r in got] == order
    assert ordered.tile_priority(rows.limit(0)).count() == 0


def test_flat_plates_go_and_ground_stays(spark):
    rows = [[float(r * 10 + c) for c in range(10)] for r in range(10)]
    for r in range(3, 6):
        for c in range(3, 7):
            rows[r][c] = 7.5
    rows[9][9] = rows[0][0] = 7.5
    left = {(r["r"], r["c"]) for r in labels.drop_plates(grid(spark, rows), least=8).collect()}
    assert {(r, c) for r in range(10) for c in range(10)} - left == {(r, c) for r in range(3, 6) for c in range(3, 7)}


def test_seeds_find_their_component(spark):
    pixels = spark.createDataFrame([(0, 0), (0, 1), (5, 5)], "r int, c int")
    seeds = spark.createDataFrame([("a", 1, 1), ("b", 0, 0), ("c", 20, 20), ("d", 4, 6)], "seed string, r int, c int")
    got = {r["seed"]: (r["r"], r["c"]) for r in labels.resolve_seeds(pixels, seeds).collect()}
    assert got == {"a": (0, 1), "b": (0, 0), "d": (5, 5)}
    assert labels.flood_component(pixels, seeds).count() == 2


def test_a_corridor_is_linear_between_gauges(spark):
    line = spark.createDataFrame([(0.0, 0.0, 1.0, 10.0, 0.0, 3.0)], "x1 double, y1 double, v1 double, x2 double, y2 double, v2 double")
    cells = spark.createDataFrame([(1, 5.0, 1.0), (2, -2.0, 0.0), (3, 5.0, 9.0)], "id int, x double, y double")
    assert {r["id"]: r["value"] for r in datum.corridor_fill(cells, line, 2.0).collect()} == {1: 2.0, 2: 1.0, 3: None}


def test_requests_have_the_right_status(spark):
    rows = [(1, 0, 0, True), (1, 2, 0, True), (-1, 0, 0, True), (9, 1, 1, True), (1, 0, 0, False), (None, 0, 0, True)]
    out = spark.createDataFrame(rows, "z int, x int, y int, ready boolean").select(serving.request_status(F.col("z"), F.col("x"), F.col("y"), 8, F.col("ready")).alias("s"))
    assert [r["s"] for r in out.collect()] == [200, 400, 400, 404, 503, 400]


def test_files_over_the_antimeridian_cover_both_sides(spark):
    edge = tiles.HALF_WORLD
    files = spark.createDataFrame([("s", "f", edge - 1000.0, 0.0, 1000.0 - edge, 1000.0)], "source string, filename string, left double, bottom double, right double, top double")
    everywhere = spark.range(256 * 256).select(F.floor(F.col("id") / 256).cast("int").alias("x"), (F.col("id") % 256).cast("int").alias("y"))
    assert sorted((r["x"], r["y"]) for r in covering.bbox_overlap_join(files, everywhere).collect()) == [(0, 127), (255, 127)]


def test_members_of_archives_and_broken_ones(spark, tmp_path):
    import gzip
    import io
    import tarfile
    import zipfile

    from soundgrid.sources import containers

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("one.tif", b"11")
        z.writestr("two.txt", b"22")
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w:gz") as t:
        info = tarfile.TarInfo("in/three.tif")
        info.size = 3
        t.addfile(info, io.BytesIO(b"333"))
    (tmp_path / "b.tar.gz").write_bytes(buffer.getvalue())
    (tmp_path / "c.tif.gz").write_bytes(gzip.compress(b"4444"))
    (tmp_path / "d.tif").write_bytes(b"55555")
    (tmp_path / "e.zip").write_bytes(b"PK\x03\x04broken")
    rows = containers.members(spark, str(tmp_path), "*.tif")
    assert {(r["member"], r["size"]) for r in rows.filter("problem is null").collect()} == {("one.tif", 2), ("in/three.tif", 3), ("c.tif", 4), ("d.tif", 5)}
    assert [r["path"].rsplit("/", 1)[-1] for r in containers.checked(rows).collect()] == ["e.zip"]


def test_recipes_are_read_with_their_source(spark, tmp_path):
    for name in ("alpha", "beta"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "metadata.json").write_text(f'{{\n "name": "{name}",\n "max_zoom": 9}}')
    got = registry.scan_sources(spark, f"{tmp_path}/*/metadata.json", "name string, max_zoom int")
    assert sorted(tuple(r) for r in got.select("source", "name", "max_zoom").collect()) == [("alpha", "alpha", 9), ("beta", "beta", 9)]


def test_segments_are_cut_to_a_box_and_chained(spark):
    kind = "id int, ax double, ay double, bx double, by double"
    cut = vectors.clip_segments(spark.createDataFrame([(1, -5.0, 5.0, 15.0, 5.0), (2, 20.0, 0.0, 20.0, 9.0), (3, 1.0, 1.0, 2.0, 2.0), (4, 5.0, -5.0, 5.0, 5.0)], kind), 0.0, 0.0, 10.0, 10.0)
    assert {tuple(r) for r in cut.collect()} == {(1, 0.0, 5.0, 10.0, 5.0), (3, 1.0, 1.0, 2.0, 2.0), (4, 5.0, 0.0, 5.0, 5.0)}
    star = [(1, 0.0, 0.0, 1.0, 0.0), (2, 1.0, 0.0, 2.0, 0.0), (3, 2.0, 0.0, 3.0, 1.0), (4, 2.0, 0.0, 3.0, -1.0)]
    assert {r["id"]: r["chain"] for r in vectors.chains(spark.createDataFrame(star, kind)).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_small_areas_far_from_the_origin_are_exact(spark):
    rows = [(1, [(39.0, 30000.0), (39.0 + 2e-9, 30000.0), (39.0 + 2e-9, 30001.0), (39.0, 30001.0)]), (2, [(39.0, 30000.0), (39.0 + 1.4e-9, 30000.0), (39.0 + 1.4e-9, 30001.0), (39.0, 30001.0)])]
    df = spark.createDataFrame(rows, "id int, ring array<struct<x: double, y: double>>")
    got = {r["id"]: round(r["lost"] * 1e9, 3) for r in vectors.snapped_within(df, 9, 1e-10, 0.5).collect()}
    assert got == {1: 0.0, 2: 0.4} and vectors.snapped_within(df.limit(0), 9, 1e-10, 0.5).count() == 0
    assert df.select(vectors.ring_area(F.array().cast("array<struct<x: double, y: double>>")).alias("a")).first()["a"] == 0.0


def test_taps_of_points_are_never_broadcast(spark):
    points = spark.range(10).select("id", F.lit(1.5).alias("x"), F.lit(2.5).alias("y"))
    grid = spark.range(64).select(F.floor(F.col("id") / 8).cast("int").alias("r"), (F.col("id") % 8).cast("int").alias("c"), F.lit(3.0).alias("z"))
    found = focal.bspline_sample(points, grid, 8)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert [round(r["value"], 12) for r in found.collect()] == [3.0] * 10


def test_points_that_share_a_place_ask_nowhere_else(spark, monkeypatch):
    rows, written = {}, near.written
    monkeypatch.setattr(near, "written", lambda df, name: rows.setdefault(name, []).append((out := written(df, name)).count()) or out)
    df = spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 20 * 3).cast("double").alias("y"))
    got = {r["id"]: (r["near_id"], r["distance"]) for r in near.nearest_neighbour(df, df, 4.0).collect()}
    assert got == {i: (i % 20 if i >= 20 else i + 20, 0.0) for i in range(400)} and set(rows["asking"]) == {0}


def test_spacing_of_points_that_share_places(spark, monkeypatch):
    from soundgrid.operators import gates

    rows, written = {}, near.written
    monkeypatch.setattr(near, "written", lambda df, name: rows.setdefault(name, []).append((out := written(df, name)).count()) or out)
    df = spark.range(101).select("id", (F.col("id") % 50).cast("double").alias("x"), F.when(F.col("id") == 100, 1e6).otherwise(0.0).alias("y"))
    got = gates.density(df, 2.0).first()
    assert (got["points"], got["alone"], got["p25"], got["p50"], got["p75"]) == (101, 1, 0.0, 0.0, 0.0) and max(rows["asking"]) == 1


def test_areas_beside_an_explode(spark):
    df = spark.createDataFrame([(1, [(0.0, 0.0), (4.0, 0.0), (0.0, 2.0)])], "id int, ring array<struct<x: double, y: double>>")
    got = df.select("id", vectors.ring_area(F.col("ring")).alias("area"), F.explode(vectors._pairs(F.col("ring"))).alias("e")).select("area", "e.a.x", "e.b.y")
    assert sorted(tuple(r) for r in got.collect()) == [(4.0, 0.0, 0.0), (4.0, 0.0, 0.0), (4.0, 4.0, 2.0)]


def test_bare_rings_agree_with_brute_force(spark):
    """Concave and nested rings, soundings that share a place, an empty ring and one that is null."""
    from soundgrid.operators import gates

    rng = random.Random(3)

    def star(x, y, size):
        return [(x + s * math.cos(k * math.pi / 5), y + s * math.sin(k * math.pi / 5)) for k in range(10) for s in [size * (1.0 if k % 2 else 0.4)]]

    def inside(p, ring):
        return sum((a[1] > p[1]) != (b[1] > p[1]) and a[0] + (p[1] - a[1]) / (b[1] - a[1]) * (b[0] - a[0]) < p[0] for a, b in zip(ring, ring[1:] + ring[:1])) % 2 == 1

    rings = [(i, rng.choice([5.0, 10.0, 15.0]), star(rng.uniform(5, 35), rng.uniform(5, 35), rng.uniform(1, 9))[:: rng.choice([1, -1])]) for i in range(60)]
    rings += [(60 + k, 15.0, star(20.1, 20.1, size)) for k, size in enumerate((3.0, 6.0, 12.0))] + [(63, 15.0, []), (64, 15.0, None)]
    ground = {(r, c): rng.choice([None, 2.0, *(-rng.uniform(0, 18) for _ in range(4))]) for r in range(40) for c in range(40)}
    soundings = [(rng.uniform(0, 40), rng.uniform(0, 40)) for _ in range(60)]
    soundings += soundings[::2] + [(None, 20.0), (20.0, None)]
    got = gates.bare_rings(
        spark.createDataFrame(rings, "id int, level double, ring array<struct<x: double, y: double>>"),
        spark.createDataFrame([(*p, z) for p, z in ground.items()], "r int, c int, z double"),
        spark.createDataFrame(soundings, "x double, y double"),
        40,
    )
    due = {}
    for i, level, ring in rings:
        depths = [-z for (r, c), z in ground.items() if z is not None and z < 0 and inside((c + 0.5, r + 0.5), ring or [])]
        if depths and min(depths) < level - 0.05:
            due[i] = (level, min(depths), not any(None not in p and inside(p, ring) for p in soundings))
    assert {r["id"]: (r["level"], r["shoalest"], r["bare"]) for r in got.collect()} == due
    assert len(due) > 40 and {bare for _, _, bare in due.values()} == {True, False}
