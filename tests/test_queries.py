"""Every query against its SQL in an independent engine, and the driver's contract."""

import datetime
import itertools
import math
from pathlib import Path

import duckdb
import numpy as np
import pytest

import __spark_entry__
from soundgrid import queries as core

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(x):
        if isinstance(x, bool) or x is None or isinstance(x, str | datetime.datetime):
            return str(x)
        return "nan" if isinstance(x, float) and math.isnan(x) else repr(round(float(x), 7) + 0.0) if isinstance(x, int | float) else str(x)

    return sorted(tuple(value(r[i]) for i in order) for r in rows), sorted(columns)


@pytest.mark.parametrize("name", sorted(core.ORACLES))
def test_query_agrees_with_sql(spark, sql, sf_dir, name):
    df = core.QUERIES[name](spark, sf_dir)
    found = sql.execute(core.ORACLES[name])
    columns = [c[0] for c in found.description]
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(found.fetchall(), columns)


# Queries without SQL, against brute force over their whole tables.


def heights(spark, sf_dir):
    from soundgrid.queries.views import surface

    return {(r["r"], r["c"]): r["z"] for r in surface(spark, sf_dir).collect()}


def patches(cells, diagonal):
    """Sets of connected cells."""
    steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i or j) and (diagonal or not (i and j))]
    left, out = set(cells), []
    while left:
        todo, own = [left.pop()], set()
        while todo:
            r, c = todo.pop()
            own.add((r, c))
            for i, j in steps:
                if (r + i, c + j) in left:
                    left.remove((r + i, c + j))
                    todo.append((r + i, c + j))
        out.append(own)
    return out


def brute_enclosed_shoals(spark, sf_dir):
    z, found = heights(spark, sf_dir), {}
    for level in (20.0, 10.0, 5.0, 2.0):
        for own in patches([p for p, v in z.items() if -level < v < 0], False):
            if not any(r % 127 == 0 or c % 127 == 0 for r, c in own):
                v, nr, nc = max((z[p], -p[0], -p[1]) for p in own)
                found[-nr, -nc] = (-nr, -nc, -v, level)
    return list(found.values()), ["r", "c", "depth", "level"]


def brute_dome_candidates(spark, sf_dir):
    z = {p: v - 16 for p, v in heights(spark, sf_dir).items()}
    out = []
    for own in patches([p for p, v in z.items() if v >= 0], True):
        top, bottom, left, right = min(r for r, _ in own), max(r for r, _ in own), min(c for _, c in own), max(c for _, c in own)
        if bottom - top >= 5 or right - left >= 5 or top < 2 or left < 2 or bottom > 125 or right > 125:
            continue
        frame = {(r, c) for r in range(top - 2, bottom + 3) for c in range(left - 2, right + 3) if r in (top - 2, bottom + 2) or c in (left - 2, right + 2)}
        valid = [z[p] for p in frame if p in z]
        if 2 * len(valid) >= len(frame) and max(valid) <= 0:
            label = min((r << 32) + c for r, c in own if r == top)
            out.append((label, len(own), max(z[p] for p in own), max(valid)))
    return out, ["label", "pixels", "high", "rim_high"]


def brute_drop_plates(spark, sf_dir):
    z = {}
    for (r, c), v in heights(spark, sf_dir).items():
        z.setdefault((r >> 1, c >> 1), []).append(v)
    z = {p: float(math.copysign(math.floor(abs(v) + 0.5), v)) + 0.0 for p, vs in z.items() for v in [max([w for w in vs if w <= 16] or vs)]}
    gone = set()
    for v in set(z.values()):
        for own in patches([p for p, w in z.items() if w == v], False):
            if len(own) >= 6:
                gone |= own
    return [(r, c, v) for (r, c), v in z.items() if (r, c) not in gone], ["r", "c", "z"]


def brute_match_1d(spark, sf_dir):
    sides = {"A": {}, "R": {}}
    for r in spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter("l_returnflag in ('A', 'R')").collect():
        sides[r["l_returnflag"]].setdefault(r["l_suppkey"] % 50, set()).add(float(r["l_partkey"] % 1000))
    out = []
    for edge in set(sides["A"]) | set(sides["R"]):
        a, b = sorted(sides["A"].get(edge, ())), sorted(sides["R"].get(edge, ()))
        while a or b:
            if a and b and abs(a[0] - b[0]) <= 1:
                out.append((edge, a.pop(0), b.pop(0)))
            elif a and (not b or a[0] < b[0]):
                out.append((edge, a.pop(0), None))
            else:
                out.append((edge, None, b.pop(0)))
    return out, ["edge", "pa", "pb"]


def brute_tile_priority(spark, sf_dir):
    from pyspark.sql import functions as F

    from soundgrid.queries.catalog import _stems

    rows = _stems(spark, sf_dir).select("stem", (F.col("child_z") - F.col("z")).alias("weight"), F.xxhash64("stem").alias("tie")).collect()
    left = sorted(rows, key=lambda r: (-r["weight"], r["tie"], r["stem"]))
    total, n, used, out = sum(r["weight"] for r in rows), len(rows), 0, []
    for k in range(n):
        r = left.pop(0) if used * n <= k * total else left.pop()
        used += r["weight"]
        out.append((r["stem"], r["weight"], k + 1))
    return out, ["stem", "weight", "place"]


def brute_gate_connectivity(spark, sf_dir):
    """The raised belt and the pond fill of the query, by hand; then components of water before and after, and the network that dried."""
    before = heights(spark, sf_dir)
    z = {(r, c): 3.0 if 40 <= r <= 44 and v < -4 else v for (r, c), v in before.items()}
    after = dict(z)
    for own in patches([p for p, v in z.items() if v < 0], True):
        high, wide = (max(p[k] for p in own) - min(p[k] for p in own) + 1 for k in (0, 1))
        rim = {(r + i, c + j) for r, c in own for i in (-1, 0, 1) for j in (-1, 0, 1)} - own
        if len(own) <= 12 and high**2 + wide**2 <= 36 and min(z[p] for p in own) >= -2 and all(p in z for p in rim):
            for p in own:
                after[p] = max(z[q] for q in rim)
    parts = {k: patches([p for p, v in of.items() if v < 0], False) for k, of in (("before", before), ("after", after))}
    largest = max(parts["before"], key=lambda p: (len(p), [-v for v in min(p)]))
    network = [p for p in parts["before"] if p == largest or any(r in (0, 127) or c in (0, 127) for r, c in p)]
    row = {"grew": sum(0 <= after[q] <= 16 for p in network for q in p)}
    for k, own in parts.items():
        n = [len(p) for p in own]
        row |= {f"water_{k}": sum(n), f"parts_{k}": len(n), f"share_{k}": max(n) / sum(n)}
    failed = ",".join(["connectivity"] * (row["share_after"] < row["share_before"] - 1e-3) + ["drying"] * (row["grew"] > 0))
    return [(*row.values(), failed or None)], [*row, "failed"]


def brute_faces(nodes):
    """Triples of ``(x, y, value)`` with no other node in their circle, by the determinant in whole numbers; of nodes on one circle the first by place counts as lifted."""
    n = np.array(sorted(map(tuple, nodes)), float).reshape(-1, 3)
    x, y = (np.round(n[:, k] * 2).astype(np.int64) for k in (0, 1))
    abc = np.array(list(itertools.combinations(range(len(n)), 3))).reshape(-1, 3)
    a, b, c = abc.T
    det = (x[b] - x[a]) * (y[c] - y[a]) - (y[b] - y[a]) * (x[c] - x[a])
    abc, det = abc[det != 0], det[det != 0]
    dx, dy = x[abc][:, :, None] - x, y[abc][:, :, None] - y
    area = lambda i, j: dx[:, i] * dy[:, j] - dx[:, j] * dy[:, i]
    inner = np.sign(det)[:, None] * ((dx[:, 0] ** 2 + dy[:, 0] ** 2) * area(1, 2) + (dx[:, 1] ** 2 + dy[:, 1] ** 2) * area(2, 0) + (dx[:, 2] ** 2 + dy[:, 2] ** 2) * area(0, 1))
    first = abc[:, :1] < np.arange(len(n))
    hit = (inner > 0) | ((inner == 0) & first & (np.sign(det)[:, None] * area(1, 2) > 0))
    np.put_along_axis(hit, abc, False, axis=1)
    return n, [tuple(f) for f in abc[~hit.any(axis=1)]]


def brute_value(n, faces, p):
    best = math.inf
    for a, b, c in faces:
        u, v, d = n[b] - n[a], n[c] - n[a], (p[0] - n[a, 0], p[1] - n[a, 1])
        det = u[0] * v[1] - u[1] * v[0]
        s, t = (d[0] * v[1] - d[1] * v[0]) / det, (d[1] * u[0] - d[0] * u[1]) / det
        if s >= -1e-9 and t >= -1e-9 and s + t <= 1 + 1e-9:
            best = min(best, n[a, 2] + s * u[2] + t * v[2])
    return best


def brute_repair_soundings(spark, sf_dir):
    z = {p: v for p, v in heights(spark, sf_dir).items() if v < 0}
    out = []
    for tile in {(r >> 5, c >> 5) for r, c in z}:
        ground = {p: v for p, v in z.items() if (p[0] >> 5, p[1] >> 5) == tile}
        inserted = {}
        for zoom, bits in ((10, 4), (11, 3)):
            cells = {}
            for (r, c), v in ground.items():
                cells.setdefault((r >> bits, c >> bits), []).append((-v, r, c))
            shown = dict(inserted)
            for depth, r, c in map(min, cells.values()):
                shown[r, c] = min(depth, shown.get((r, c), math.inf))
            if len(shown) < 3:
                continue
            n, faces = brute_faces([(c + 0.5, r + 0.5, d) for (r, c), d in shown.items()])
            bad = []
            for (r, c), v in ground.items():
                error = -v - brute_value(n, faces, (c + 0.5, r + 0.5))
                if error > max(2.0, -v / 2) and 0.2 <= -v <= 200:
                    bad.append((-round(error, 9), r, c))
            taken = []
            for error, r, c in sorted(bad):
                if all((r - i) ** 2 + (c - j) ** 2 >= (4 * 2 ** (11 - zoom)) ** 2 for i, j in [*shown, *taken]):
                    taken.append((r, c))
                    out.append((*tile, zoom, r, c, -ground[r, c], -error))
            inserted |= {p: -ground[p] for p in taken}
    return out, ["tile_r", "tile_c", "zoom", "r", "c", "depth", "error"]


def brute_coverage_feather(spark, sf_dir):
    """On the whole grid at once, with the cover as a set."""
    from soundgrid.queries.views import px

    z = {(r["r"], r["c"]): r["z"] for r in px(spark, sf_dir).filter("src = 'N'").collect()}
    every = list(itertools.product(range(128), range(128)))
    taps = {k: math.exp(-0.5 * (k / 2.5) ** 2) for k in range(-10, 11)}
    total, clip = sum(taps.values()), lambda v: min(max(v, 0), 127)
    along = {(r, c): sum(w * ((r, clip(c + k)) in z) for k, w in taps.items()) / total for r, c in every}
    wanted = {(r, c) for r, c in every if round(sum(w * along[clip(r + k), c] for k, w in taps.items()) / total, 9) >= 0.5}
    cover = set(z) | wanted
    loose = cover - wanted
    around = [(-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1)]
    for _ in range(7):
        for field in itertools.product((0, 1), (0, 1)):
            here = {p: [(p[0] + i, p[1] + j) in cover for i, j in around] for p in loose & cover if (p[0] % 2, p[1] % 2) == field}
            cover -= {p for p, ring in here.items() if sum(ring[k] and not ring[k - 1] for k in range(8)) == 1}
    out = []
    for r, c in every:
        near = min(((r - i) ** 2 + (c - j) ** 2, i, j) for i, j in z) if (r, c) in cover and (r, c) not in z else (0, r, c)
        out.append((r, c, z.get((r, c)), z[near[1:]] if (r, c) in cover else None))
    return out, ["r", "c", "z", "feathered"]


BRUTE = {"enclosed_shoals": brute_enclosed_shoals, "dome_candidates": brute_dome_candidates, "drop_plates": brute_drop_plates, "match_1d": brute_match_1d, "tile_priority": brute_tile_priority, "repair_soundings": brute_repair_soundings, "coverage_feather": brute_coverage_feather, "gate_connectivity": brute_gate_connectivity}


def test_every_query_has_sql_or_brute_force():
    assert set(core.QUERIES) - set(core.ORACLES) == set(BRUTE)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(BRUTE))
def test_query_agrees_with_brute_force(spark, name, sf):
    sf_dir = f"/root/testdata/{sf}"
    df = core.QUERIES[name](spark, sf_dir)
    rows, columns = BRUTE[name](spark, sf_dir)
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(rows, columns) and (rows or sf == "sf0.001")


def test_ponds_may_dry_and_channels_may_not(spark):
    """A pond inland, a channel to the rim, the largest water inland."""
    from soundgrid.operators import gates

    land = {(r, c): 1.0 for r in range(9) for c in range(9)}
    water = [(2, 2), (4, 4), (4, 5), (4, 6), (5, 4), *((7, c) for c in range(3))]
    frame = lambda of: spark.createDataFrame([(*p, v) for p, v in of.items()], "r int, c int, z double")
    before = land | dict.fromkeys(water, -3.0)
    run = lambda dry: tuple(gates.connectivity(frame(before), frame(before | dict.fromkeys(dry, 0.5)), (0, 0, 8, 8)).select("grew", "failed").first())
    assert run([(2, 2)]) == (0, None) and run([(7, 1)]) == (1, "drying") and run([(4, 5)]) == (1, "connectivity,drying")
    assert tuple(gates.connectivity(frame(land), frame(land), (0, 0, 8, 8)).first()) == (0, 0, 0.0, 0, 0, 0.0, 0, None)


def test_entry_gives_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_sql_only_for_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_else_imports_the_corpus_subpackage():
    root = Path(core.__file__).resolve().parents[1]
    for source in root.rglob("*.py"):
        if "llm" not in source.relative_to(root).parts:
            assert "soundgrid.llm" not in source.read_text(), source


@pytest.mark.parametrize("name", ["priority_fill", "shoal_pyramid", "bbox_overlap_join", "level_lines", "finer_index", "ancestor_lookup", "nearest_neighbour", "interval_intersect", "shared_edge_join", "classified_product"])
def test_no_nested_loop_join(spark, sf_dir, name):
    plan = core.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = core.QUERIES["water_window_read"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_custkey,100)" in plan and "o_totalprice" not in plan
