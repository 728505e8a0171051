"""Content of vector tiles: payloads there and back, clipping against plain geometry, checks of whole archives."""

import json
import math
import random

from pyspark.sql import functions as F

from soundgrid.operators import tilechecks, vectortiles

FEATURES = f"z int, x long, y long, {vectortiles.FEATURE}"


def random_feature(rng, number):
    kind = rng.choice([1, 2, 3])
    at = lambda: {"x": rng.randrange(-80, 4177), "y": rng.randrange(-80, 4177)}
    parts = [[at()] for _ in range(rng.randrange(1, 4))] if kind == 1 else [[at() for _ in range(rng.randrange(kind, 9))] for _ in range(rng.randrange(1, 4))]
    values = ["12", "-7", "0", "3.25", "-1e-09", "true", "false", '"m"', '"é 水 \\" "', str(1 << 40)]
    properties = {f"k{i}": rng.choice(values) for i in range(rng.randrange(4))}
    return (rng.randrange(3), rng.randrange(2), rng.randrange(2), rng.choice("ab"), number, kind, parts, properties)


def plain(rows):
    own = lambda v: json.loads(v)
    return sorted(repr((r["z"], r["x"], r["y"], r["layer"], r["id"], r["kind"], [[tuple(p) for p in part] for part in r["parts"]], sorted((k, own(v)) for k, v in r["properties"].items() if v is not None))) for r in rows)


def test_reading_a_payload_gives_what_was_packed(spark):
    rng = random.Random(3)
    rows = [random_feature(rng, i) for i in range(120)]
    rows += [(0, 0, 0, "a", None, 1, [[{"x": 1, "y": 2}]], {"gone": None, "there": "1"}), (0, 0, 0, "", 5, 1, [[{"x": 0, "y": 0}]], {})]
    df = spark.createDataFrame(rows, FEATURES)
    tiles = vectortiles.packed(df.repartition(5))
    again = vectortiles.packed(df)
    payloads = lambda d: {tuple(r)[:3]: bytes(r["payload"]) for r in d.collect()}
    assert payloads(tiles) == payloads(again)
    assert plain(vectortiles.unpacked(tiles).collect()) == plain(df.collect())
    odd = spark.createDataFrame([(0, 0, 0, None), (0, 0, 1, bytearray())], "z int, x long, y long, payload binary")
    assert vectortiles.unpacked(odd).count() == 0 and vectortiles.packed(df.limit(0)).count() == 0


def test_commands_and_values_are_those_of_the_published_format():
    assert vectortiles.commands(1, [[(25, 17)]]) == [9, 50, 34]
    assert vectortiles.commands(1, [[(5, 7)], [(3, 2)]]) == [17, 10, 14, 3, 9]
    assert vectortiles.commands(2, [[(2, 2), (2, 10), (10, 10)], [(1, 1), (3, 5)]]) == [9, 4, 4, 18, 0, 16, 16, 0, 9, 17, 17, 10, 4, 8]
    assert vectortiles.commands(3, [[(3, 6), (8, 12), (20, 34)]]) == [9, 6, 12, 18, 10, 12, 24, 44, 15]
    assert vectortiles.digits(300) == b"\xac\x02" and [vectortiles.folded(n) for n in (0, -1, 1, -2)] == [0, 1, 2, 3]
    by_others = vectortiles.field(4, 150) + b"\x15\x00\x00\x80\x3f"  # an int and a float field, as other writers have them
    assert vectortiles.decoded_value(vectortiles.field(5, 150)) == "150" and vectortiles.decoded_value(b"\x15\x00\x00\x80\x3f") == "1.0"
    assert vectortiles.decoded_value(by_others) == "150" and vectortiles.decoded_value(vectortiles.field(4, (1 << 64) - 3)) == "-3"


def between(p, a, b, slack):
    """Whether a place lies on a segment, to a distance along each axis."""
    return min(a[0], b[0]) - slack <= p[0] <= max(a[0], b[0]) + slack and min(a[1], b[1]) - slack <= p[1] <= max(a[1], b[1]) + slack and abs((b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])) <= slack * (abs(b[0] - a[0]) + abs(b[1] - a[1]))


def inside_length(a, b, low, high):
    t0, t1 = 0.0, 1.0
    for k in (0, 1):
        d = b[k] - a[k]
        for room, way in ((a[k] - low, -d), (high - a[k], d)):
            if way == 0:
                if room < 0:
                    return 0.0
            elif way > 0:
                t1 = min(t1, room / way)
            else:
                t0 = max(t0, room / way)
    return max(0.0, t1 - t0) * ((b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2) ** 0.5


def test_lines_are_cut_to_what_lies_in_the_square():
    rng = random.Random(9)
    for _ in range(400):
        line = [(rng.randrange(-3000, 7000), rng.randrange(-3000, 7000)) for _ in range(rng.randrange(2, 7))]
        out = vectortiles.cut_line(line, -80, 4176)
        assert all(-80 <= x <= 4176 and -80 <= y <= 4176 for part in out for x, y in part)
        length = sum(((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2) ** 0.5 for part in out for a, b in zip(part, part[1:]))
        due = sum(inside_length(a, b, -80, 4176) for a, b in zip(line, line[1:]))
        assert abs(length - due) <= 6 * len(line) and all(any(between(p, a, b, 3) for a, b in zip(line, line[1:])) for part in out for p in part)
    assert vectortiles.cut_line([(-100, 0), (-90, 0)], -80, 4176) == [] and vectortiles.cut_line([(0, 0), (5000, 0), (0, 10)], -80, 4176) == [[(0, 0), (4176, 0)], [(4176, 1), (0, 10)]]
    assert [vectortiles.quotient(-7, 2), vectortiles.quotient(7, -2), vectortiles.nearest(-2.5), vectortiles.nearest(2.5)] == [-3, -3, -3, 3]


def test_rings_are_cut_to_the_area_that_lies_in_the_square():
    rng = random.Random(2)
    n = 64
    for _ in range(60):
        cx, cy = rng.randrange(-1000, 5000), rng.randrange(-1000, 5000)
        ring = [(int(cx + r * math.cos(2 * math.pi * k / 11)), int(cy + r * math.sin(2 * math.pi * k / 11))) for k in range(11) for r in [rng.randrange(300, 2500)]]
        out = vectortiles.cut_ring(ring, -80, 4176)
        assert all(-80 <= x <= 4176 and -80 <= y <= 4176 for x, y in out)

        def within(p, poly):
            hit = False
            for a, b in zip(poly, poly[1:] + poly[:1]):
                if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] + (p[1] - a[1]) / (b[1] - a[1]) * (b[0] - a[0]):
                    hit = not hit
            return hit

        for i in range(n):
            p = (rng.uniform(-79, 4175), rng.uniform(-79, 4175))
            assert within(p, ring) == (within(p, out) if out else False)
    assert vectortiles.cut_ring([(-200, 0), (-80, 0), (-80, 50)], -80, 4176) == []


def test_degenerate_parts_go_and_neighbours_agree_on_their_seam():
    unit = 1 << 20  # a unit of a tile at zoom 0
    at = lambda points: [(int(x * unit), int(y * unit)) for x, y in points]
    assert vectortiles.into_tile(2, [at([(1, 1), (1.2, 1.1)])], 0, 0, 0) == []
    assert vectortiles.into_tile(3, [at([(1, 1), (9, 1), (5, 1.2)])], 0, 0, 0) == []
    assert vectortiles.into_tile(3, [at([(1, 1), (9, 1), (5, 3)]), at([(2, 2), (2.1, 2), (2, 2.1)])], 0, 0, 0) == [[(1, 1), (9, 1), (5, 3)]]
    assert vectortiles.into_tile(1, [at([(1, 1)]), at([(5000, 1)])], 0, 0, 0) == [[(1, 1)]]
    assert vectortiles.into_tile(2, [at([(0, 10), (1, 10), (1, 10.2), (3, 12)])], 0, 0, 0) == [[(0, 10), (1, 10), (3, 12)]]
    ring = at([(1000, 1000), (3000, 1300), (2800, 3100), (1200, 2700)])
    left, right = (vectortiles.into_tile(3, [ring], 1, x, 0, buffer=0) for x in (0, 1))
    seam = lambda parts, x: sorted(y for part in parts for a, y in part if a == x)
    assert seam(left, 4096) == seam(right, 0) and len(seam(left, 4096)) == 2


def test_tiles_and_overzoomed_tiles_of_features(spark):
    rows = [("a", 1, 2, [[{"x": 0.1, "y": 0.1}, {"x": 0.9, "y": 0.1}]], {"n": "1"}, 0, None), ("b", 2, 3, [[{"x": 0.4, "y": 0.4}, {"x": 0.6, "y": 0.4}, {"x": 0.6, "y": 0.6}, {"x": 0.4, "y": 0.6}]], {}, 1, 1), ("c", 3, 1, [[{"x": 0.5, "y": 0.25}]], {}, 0, 1), ("c", 4, 1, [], {}, 0, None)]
    df = spark.createDataFrame(rows, "layer string, id long, kind int, parts array<array<struct<x: double, y: double>>>, properties map<string, string>, minzoom int, lastzoom int")
    found = {(r["z"], r["x"], r["y"], r["id"]): [[tuple(p) for p in part] for part in r["parts"]] for r in vectortiles.tiled(df, 2).collect()}
    assert found[0, 0, 0, 1] == [[(410, 410), (3686, 410)]] and found[1, 0, 0, 2] == [[(3277, 4176), (3277, 3277), (4176, 3277), (4176, 4176)]]
    assert {k[:3] for k in found if k[3] == 3} == {(0, 0, 0), (1, 0, 0), (1, 1, 0)}  # on a seam, in both
    assert {k[:3] for k in found if k[3] == 2} == {(1, x, y) for x in (0, 1) for y in (0, 1)} and not any(k[3] == 4 for k in found)
    tiles = vectortiles.tiled(df, 2).withColumn("extent", F.lit(4096))
    requests = spark.createDataFrame([(3, 0, 0, 2), (3, 6, 0, 2), (4, 15, 15, 2)], "z int, x long, y long, found_z int")
    own = {(r["x"], r["y"]): [[tuple(p) for p in part] for part in r["parts"]] for r in vectortiles.overzoomed(tiles, requests).collect()}
    assert own == {(0, 0): [[(3276, 3276), (4176, 3276)]], (6, 0): [[(-80, 3276), (4176, 3276)]]}
    merged = vectortiles.coalesced(tiles.withColumn("id", F.col("id") + 10).unionByName(tiles).filter("z = 0 and layer = 'a'")).collect()
    assert len(merged) == 1 and merged[0]["id"] == 1 and len(merged[0]["parts"]) == 2


def test_an_archive_that_is_whole_has_no_problems(spark):
    square = lambda a, b, s: [{"x": a, "y": b}, {"x": a + s, "y": b}, {"x": a + s, "y": b + s}, {"x": a, "y": b + s}]
    rows = [(0, 0, 0, "depare", 1, 3, [square(0, 0, 2048), square(500, 500, 100)[::-1]], {}), (0, 0, 0, "depare", 2, 3, [square(2047, 0, 2049)], {}), (0, 0, 0, "soundings", 7, 1, [[{"x": 3, "y": 3}]], {})]
    rows += [(1, x, y, "depare", 1, 3, [square(0, 0, 4096), square(1000, 1000, 200)[::-1]], {}) if (x, y) == (0, 0) else (1, x, y, "depare", 2, 3, [square(-80, -80, 4256)], {}) for x in (0, 1) for y in (0, 1)]
    df = spark.createDataFrame(rows, FEATURES)
    expected = spark.createDataFrame([("depare", 1), ("depare", 2), ("soundings", 7)], "layer string, id long")
    run = lambda d: sorted((r["problem"], r["z"], r["x"], r["y"], r["id"]) for r in tilechecks.selfcheck(d, expected, F.lit(0), F.col("layer") == "depare").collect())
    assert run(df) == []
    assert run(df.filter("not (z = 1 and x = 0 and y = 0)")) == []  # three of four children: nothing to compare
    assert run(df.filter("id <> 1 or z = 0").unionByName(df.filter("z = 1 and x = 0 and y = 0").withColumn("parts", F.transform("parts", lambda p: F.slice(p, 1, 3))))) == [("lost", 0, 0, 0, None)]
    assert run(df.filter("id <> 7")) == [("absent", None, None, None, 7), ("no soundings", None, None, None, None)]


def test_a_check_cuts_its_bands_once(spark, monkeypatch):
    made = {"tile_polygons": 0, "convex_parts": 0}

    def counted(name):
        own = getattr(tilechecks, name)

        def run(*args, **more):
            made[name] += 1
            return own(*args, **more)

        return run

    for name in ("tile_polygons", "convex_parts"):
        monkeypatch.setattr(tilechecks, name, counted(name), raising=False)
    square = [{"x": 0, "y": 0}, {"x": 4096, "y": 0}, {"x": 4096, "y": 4096}, {"x": 0, "y": 4096}]
    beyond = [{"x": 1024, "y": -80}, {"x": 4176, "y": -80}, {"x": 4176, "y": 2048}, {"x": 1024, "y": 2048}]
    df = spark.createDataFrame([(0, 0, 0, "depare", 1, 3, [square], {}), (0, 0, 0, "depare", 2, 3, [beyond], {})], FEATURES)
    expected = spark.createDataFrame([("depare", 1)], "layer string, id long")
    found = {(r["problem"], r["id"], r["value"]) for r in tilechecks.selfcheck(df, expected, F.lit(0), F.col("layer") == "depare").collect()}
    assert found == {("overlap", 1, 3072.0 * 2048.0), ("no soundings", None, None)} and made == {"tile_polygons": 1, "convex_parts": 1}


def test_a_large_tile_is_packed_and_read_by_many_tasks(spark):
    own = F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).otherwise('"odd"')
    at = F.struct((F.col("id") % 4096).alias("x"), (F.col("id") % 77 - 40).alias("y"))
    features = spark.range(20000).select(F.lit(3).alias("z"), F.lit(1).cast("long").alias("x"), F.lit(2).cast("long").alias("y"), F.lit("a").alias("layer"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("id"), F.lit(2).alias("kind"), F.array(F.array(at, at)).alias("parts"), F.create_map(F.lit("n"), own).alias("properties"))
    tiles = vectortiles.packed(features)
    assert tiles.count() == 1
    back = vectortiles.unpacked(tiles).withColumn("task", F.spark_partition_id()).collect()
    assert plain(back) == plain(features.collect()) and len({r["task"] for r in back}) > 1
    payload = bytes(vectortiles.packed(features.unionByName(features.withColumn("layer", F.lit("b")))).first()["payload"])
    counts = [(name, len(names), len(values), sum(1 for _ in vectortiles.features_of(s, names, values))) for name, _, names, values, s in vectortiles.stretches(payload, 1000)]
    # 10,001 values and a name: no stretch but the last one has fewer features.
    assert counts == [(name, 1, 10001, n) for name in "ab" for n in (11000, 9000)]


def test_tiles_from_one_task_are_cut_by_many_and_none_is_missed(spark):
    rng = random.Random(12)
    place = lambda: {"x": rng.uniform(-0.1, 1.1), "y": rng.uniform(-0.1, 1.1)}
    rows = [("a", i, kind, [[place()] for _ in range(3)] if kind == 1 else [[place() for _ in range(4)] for _ in range(2)], {}, i % 3, None) for i in range(60) for kind in [i % 3 + 1]]
    df = spark.createDataFrame(rows, "layer string, id long, kind int, parts array<array<struct<x: double, y: double>>>, properties map<string, string>, minzoom int, lastzoom int").coalesce(1)
    tiles = vectortiles.tiled(df, 3)
    found = {(r["z"], r["x"], r["y"], r["id"]): [[tuple(p) for p in part] for part in r["parts"]] for r in tiles.collect()}
    world = lambda v: vectortiles.nearest(v * (1 << 32))
    due = {(z, x, y, i): own for _, i, kind, parts, _, low, _ in rows for z in range(low, 4) for x in range(1 << z) for y in range(1 << z) if (own := vectortiles.into_tile(kind, [[(world(p["x"]), world(p["y"])) for p in part] for part in parts], z, x, y))}
    assert found == due and tiles.rdd.getNumPartitions() > 1
