"""Queries of polygon partitions, of what a listing, a registration and an index refuse, and of gates over vector tiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundgrid.operators import gates, merge, partition, polygons
from soundgrid.queries import query
from soundgrid.queries.charting import BOXES, _boxes
from soundgrid.queries.surfaces import CELLS
from soundgrid.queries.views import surface, table, with_views
from soundgrid.sinks import tables
from soundgrid.sources import registry

# Boxes of ten by ten without a notch of n by m in the upper right corner; wide ones reach into the next box by a quarter or half of it.
WIDE = "SELECT id, p_size, i, j, j % 2 AS sys, p_size % 3 * CAST(0.25 AS DOUBLE) AS e, 2 + p_size % 3 AS n, (1 + p_size % 7) * CAST(0.5 AS DOUBLE) AS m FROM boxes"
SHARED = "SELECT low, high, sys, area, area * 2 / rim AS width FROM (SELECT a.id AS low, b.id AS high, a.sys, a.e * 100 - least(a.n, a.e * 10) * a.m AS area, (a.e * 10 + 10) * 2 - CASE WHEN a.n >= a.e * 10 THEN 2 * a.m ELSE 0 END AS rim FROM wide a JOIN wide b ON b.j = a.j AND b.i = a.i + 1 WHERE a.e > 0) s"


def _tens(spark, sf_dir, right=0.0):
    """The boxes, ten times as large, whose right side is moved by ``right`` boxes."""
    b = _boxes(spark, sf_dir)
    x, y = F.col("ring")[0]["x"] * 10.0, F.col("ring")[0]["y"] * 10.0
    stop = x + 10.0 + F.lit(right) * 10.0
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ring = F.array(at(x, y), at(stop, y), at(stop, y + 10.0), at(x, y + 10.0))
    return b.select("id", "p_size", (F.floor(F.col("id") / 40) % 2).alias("sys"), ring.alias("ring"))


def _notched(boxes):
    """Boxes without their upper right corner: six points, not convex, every other one clockwise."""
    n, m = (F.col("p_size") % 3 + 2).cast("double"), (F.col("p_size") % 7 + 1) * 0.5
    x0, y0, x1, y1 = F.col("ring")[0]["x"], F.col("ring")[0]["y"], F.col("ring")[2]["x"], F.col("ring")[2]["y"]
    around = ((x0, y0), (x1, y0), (x1, y1 - m), (x1 - n, y1 - m), (x1 - n, y1), (x0, y1))
    ring = F.array(*(F.struct(x.alias("x"), y.alias("y")) for x, y in around))
    return boxes.withColumn("ring", F.when(F.col("id") % 2 == 0, ring).otherwise(F.reverse(ring)))


def _wide(spark, sf_dir):
    return _notched(_tens(spark, sf_dir, F.col("p_size") % 3 * 0.25))


@query(with_views("SELECT low, high, round(area, 6) AS area, round(width, 6) AS width FROM shared", boxes=BOXES, wide=WIDE, shared=SHARED))
def overlap_pairs(spark, sf_dir):
    found = partition.overlap_pairs(_wide(spark, sf_dir), 25.0)
    return found.select("low", "high", F.round("area", 6).alias("area"), F.round("width", 6).alias("width"))


@query(with_views("SELECT t.sys, coalesce(wide_pairs, 0) AS wide_pairs, round(coalesce(widest, 0), 6) AS widest, round(drift, 6) AS drift, round(budget, 6) AS budget, coalesce(wide_pairs, 0) > 0 OR drift > budget AS failed FROM (SELECT sys, sum(100 * e) AS drift, greatest(sum(100 - n * m) * CAST(0.00001 AS DOUBLE), CAST(1.5 AS DOUBLE) * sum(80 + 20 * e)) AS budget FROM wide GROUP BY 1) t LEFT JOIN (SELECT sys, count(*) FILTER (width > 3) AS wide_pairs, max(width) AS widest FROM shared GROUP BY 1) s ON s.sys = t.sys", boxes=BOXES, wide=WIDE, shared=SHARED))
def gate_partition(spark, sf_dir):
    found = partition.gate_partition(_notched(_tens(spark, sf_dir)), _wide(spark, sf_dir), ["sys"], 25.0, 3.0)
    return found.withColumns({c: F.round(c, 6) for c in ("widest", "drift", "budget")})


NEXT = "SELECT a.p_size % 4 AS band, a.p_size % 5 AS fifth, b.p_size % 4 AS other_band, b.p_size % 5 AS other_fifth, b.j > a.j AS above FROM boxes a JOIN boxes b ON (b.i = a.i + 1 AND b.j = a.j) OR (b.i = a.i AND b.j = a.j + 1)"


@query(with_views("SELECT b.fifth AS band, n AS parts, CAST(4 * n - 2 * coalesce(k, 0) AS BIGINT) AS edges, CAST(4 * n - 2 * coalesce(k, 0) AS DOUBLE) AS rim, CAST(n AS DOUBLE) AS area, true AS identity FROM (SELECT p_size % 5 AS fifth, count(*) AS n FROM boxes GROUP BY 1) b LEFT JOIN (SELECT fifth, count(*) AS k FROM touching WHERE fifth = other_fifth GROUP BY 1) t ON t.fifth = b.fifth", boxes=BOXES, touching=NEXT.replace("ON (b.i = a.i + 1 AND b.j = a.j) OR (b.i = a.i AND b.j = a.j + 1)", "ON b.i = a.i + 1 AND b.j = a.j") + " UNION ALL " + NEXT.replace("ON (b.i = a.i + 1 AND b.j = a.j) OR (b.i = a.i AND b.j = a.j + 1)", "ON b.i = a.i AND b.j = a.j + 1")))
def coverage_union(spark, sf_dir):
    """Unit boxes dissolved by a fifth of their sizes."""
    return partition.coverage_union(_boxes(spark, sf_dir).withColumn("band", F.col("p_size") % 5), ["band"])


def _dotted(spark, sf_dir):
    """Unit boxes with a point in the middle of each side."""
    x, y = F.col("ring")[0]["x"], F.col("ring")[0]["y"]
    at = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    around = ((0.0, 0.0), (0.5, 0.0), (1.0, 0.0), (1.0, 0.5), (1.0, 1.0), (0.5, 1.0), (0.0, 1.0), (0.0, 0.5))
    return _boxes(spark, sf_dir).select("id", (F.col("p_size") % 5).alias("band"), F.array(*(at(*p) for p in around)).alias("ring"))


BUMPS = "SELECT id, p_size % 5 AS band, (i * 7 + j * 3) % 4 * CAST(0.1 AS DOUBLE) AS low, (i * 7 + (j + 1) * 3) % 4 * CAST(0.1 AS DOUBLE) AS high FROM boxes"


@query(with_views("SELECT id, band, 4 + CAST(low > 0.15 AS INT) + CAST(high > 0.15 AS INT) AS vertices, round(1 - CASE WHEN low > 0.15 THEN low / 2 ELSE 0 END + CASE WHEN high > 0.15 THEN high / 2 ELSE 0 END, 9) AS area, true AS simplified FROM bumps", boxes=BOXES, bumps=BUMPS))
def coverage_simplify(spark, sf_dir):
    """Points in the middle of straight sides go, and of sides bent by a tenth; those of sides bent further stay, for both neighbours, and so do corners."""
    x, y = F.col("ring")[0]["x"], F.col("ring")[0]["y"]
    at = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    bent = lambda row: (x * 7 + row * 3) % 4 * 0.1
    around = ((0.0, 0.0), (0.5, bent(y)), (1.0, 0.0), (1.0, 0.5), (1.0, 1.0), (0.5, 1.0 + bent(y + 1)), (0.0, 1.0), (0.0, 0.5))
    dotted = _boxes(spark, sf_dir).select("id", (F.col("p_size") % 5).alias("band"), F.array(*(at(F.lit(dx), dy if not isinstance(dy, float) else F.lit(dy)) for dx, dy in around)).alias("ring"))
    found = partition.coverage_simplify(dotted, ["band"], 0.3, guard=0.5)
    return found.select("id", "band", F.size("ring").alias("vertices"), F.round(partition.ring_area(F.col("ring")), 9).alias("area"), "simplified")


@query(with_views("SELECT id, 5 AS vertices, CAST(0.5 AS DOUBLE) AS area FROM boxes, range(2)", boxes=BOXES))
def subdivide(spark, sf_dir):
    """Rings of eight points, halved."""
    found = partition.subdivided(_dotted(spark, sf_dir), 6, 4)
    return found.select("id", F.size("ring").alias("vertices"), partition.ring_area(F.col("ring")).alias("area"))


@query(with_views("SELECT id, CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END AS parts, CASE WHEN p_size % 2 = 0 THEN (1 + p_size % 3) / CAST(2 AS DOUBLE) ELSE CAST(1 + p_size % 3 AS DOUBLE) END AS area, CAST(CASE WHEN p_size % 2 = 0 THEN 6 ELSE 4 END AS BIGINT) AS points FROM boxes", boxes=BOXES))
def repair(spark, sf_dir):
    """Every other box with two corners exchanged, so that its sides cross: two triangles each."""
    x, y = F.col("ring")[0]["x"], F.col("ring")[0]["y"]
    at = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    w = F.col("p_size") % 3 + 1.0
    crossed = F.array(at(0.0, 0.0), at(w, 0.0), at(0.0, 1.0), at(w, 1.0))
    box = F.array(at(0.0, 0.0), at(w, 0.0), at(w, 1.0), at(0.0, 1.0))
    found = polygons.repaired(_boxes(spark, sf_dir).select("id", F.when(F.col("p_size") % 2 == 0, crossed).otherwise(box).alias("ring")), ["id"])
    return found.groupBy("id").agg(F.count(F.lit(1)).cast("int").alias("parts"), F.sum(polygons.polygon_area(found)).alias("area"), F.sum(F.size("ring")).alias("points"))


@query(with_views("SELECT band, round(churn, 6) AS churn, budget, CASE WHEN band = 3 THEN 'gone' WHEN churn > budget THEN 'moved' END AS wrong FROM (SELECT b.band, CASE WHEN b.band = 3 THEN NULL WHEN b.band = 1 THEN CAST(50 * n AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS churn, CASE WHEN b.band = 3 THEN NULL WHEN b.band = 1 THEN (40 * n - 20 * coalesce(k, 0) + 30 * n - 10 * coalesce(v, 0)) * CAST(0.375 AS DOUBLE) ELSE (80 * n - 40 * coalesce(k, 0)) * CAST(0.375 AS DOUBLE) END AS budget FROM (SELECT p_size % 4 AS band, count(*) AS n FROM boxes GROUP BY 1) b LEFT JOIN (SELECT band, count(*) AS k, count(*) FILTER (above) AS v FROM touching WHERE band = other_band GROUP BY 1) t ON t.band = b.band) q", boxes=BOXES, touching=NEXT.replace("ON (b.i = a.i + 1 AND b.j = a.j) OR (b.i = a.i AND b.j = a.j + 1)", "ON b.i = a.i + 1 AND b.j = a.j") + " UNION ALL " + NEXT.replace("ON (b.i = a.i + 1 AND b.j = a.j) OR (b.i = a.i AND b.j = a.j + 1)", "ON b.i = a.i AND b.j = a.j + 1")))
def gate_displacement(spark, sf_dir):
    """One band loses the right half of its boxes, one is gone."""
    band = F.col("p_size") % 4
    before, after = _tens(spark, sf_dir).withColumn("band", band), _tens(spark, sf_dir, F.when(F.col("p_size") % 4 == 1, -0.5).otherwise(0.0)).withColumn("band", band).filter("band <> 3")
    return partition.gate_displacement(before, after, ["band"], 25.0, 0.5).withColumn("churn", F.round("churn", 6))


LEFT = "SELECT j, p_size, CASE WHEN m > CAST(1.2 AS DOUBLE) THEN 10 - n ELSE 10 END AS inside FROM wide"


@query(with_views("SELECT route, round(was, 9) AS was, round(now, 9) AS now, CASE WHEN now IS NULL THEN 'gone' ELSE 'less' END AS wrong FROM (SELECT route, was, CASE WHEN route % 11 <> 5 THEN now END AS now FROM (SELECT j AS route, coalesce(sum(inside) FILTER (p_size >= j % 3 * 10), 0) / CAST(400 AS DOUBLE) AS was, coalesce(sum(inside) FILTER (p_size >= j % 3 * 10 AND p_size % 4 <> 3), 0) / CAST(400 AS DOUBLE) AS now FROM inside GROUP BY 1) t) u WHERE now IS NULL OR now < was - 0.001", boxes=BOXES, wide=WIDE, inside=LEFT))
def gate_routes(spark, sf_dir):
    """A route along the upper part of each row of boxes, through those notches that reach it."""
    rows = _boxes(spark, sf_dir).select(F.col("ring")[0]["y"].cast("long").alias("route")).distinct()
    y = F.col("route") * 10.0 + 8.8
    routes = rows.select("route", F.lit(0.0).alias("ax"), y.alias("ay"), F.lit(400.0).alias("bx"), y.alias("by"), (F.col("route") % 3 * 10).cast("double").alias("need"))
    deep = _notched(_tens(spark, sf_dir)).withColumn("deep", F.col("p_size").cast("double"))
    before = partition.covered_routes(routes, deep, 50.0)
    after = partition.covered_routes(routes.filter("route % 11 <> 5"), deep.filter("p_size % 4 <> 3"), 50.0)
    return partition.gate_routes(before, after).withColumns({"was": F.round("was", 9), "now": F.round("now", 9)})


# Listings, registrations and the index.

RECIPES = "SELECT 'n' || CAST(n_nationkey AS VARCHAR) AS source, n_nationkey AS k, CASE n_nationkey % 4 WHEN 1 THEN '*1*|*7' WHEN 2 THEN 'zzz*' WHEN 3 THEN 'http://a.b/*?2' END AS filter, CASE WHEN n_nationkey % 8 = 7 THEN 'oldest' WHEN n_nationkey % 5 = 0 THEN 'newest' END AS dedupe FROM nation"
ENTERED = "SELECT source, 'list' || CAST(k % 3 AS VARCHAR) || CASE WHEN k % 4 <> 0 OR k = 8 THEN '/' ELSE '' END AS entry FROM recipes UNION ALL SELECT source, 'more' FROM recipes"
OFFERED = "SELECT 'list' || CAST(c_custkey % 3 AS VARCHAR) || '/' AS entry, 'http://a.b/' || CAST(c_custkey AS VARCHAR) AS url, c_nationkey AS cell, CASE WHEN c_custkey % 3 <> 1 THEN c_acctbal END AS modified FROM customer"
PASSING = "SELECT r.source, r.dedupe, l.url, l.cell, l.modified FROM recipes r JOIN entered e ON e.source = r.source JOIN offered l ON l.entry = e.entry WHERE (r.k % 4 = 1 AND (l.url LIKE '%1%' OR l.url LIKE '%7')) OR (r.k % 4 = 2 AND l.url LIKE 'zzz%') OR (r.k % 4 = 3 AND l.url LIKE 'http://a.b/%_2')"
FAULTS = "SELECT r.source, CASE WHEN filter IS NULL AND dedupe IS NOT NULL THEN 'dedupe without filter' WHEN filter IS NULL AND k = 8 THEN 'prefix without filter' WHEN filter IS NOT NULL AND dedupe = 'oldest' THEN 'unknown dedupe' WHEN filter IS NOT NULL AND n IS NULL THEN 'filter passes nothing' WHEN filter IS NOT NULL AND dedupe = 'newest' AND timed < n THEN 'dedupe without times' END AS problem FROM recipes r LEFT JOIN (SELECT source, count(*) AS n, count(modified) AS timed FROM passing GROUP BY 1) p ON p.source = r.source"


@query(with_views("SELECT e.source, e.entry AS url, false AS listed, NULL AS problem FROM entered e JOIN recipes r ON r.source = e.source JOIN faults f ON f.source = e.source WHERE r.filter IS NULL AND f.problem IS NULL UNION ALL SELECT p.source, url, true, NULL FROM passing p JOIN faults f ON f.source = p.source WHERE f.problem IS NULL AND dedupe IS NULL UNION ALL SELECT source, url, true, NULL FROM (SELECT p.source, url, row_number() OVER (PARTITION BY p.source, cell ORDER BY modified DESC, url DESC) AS q FROM passing p JOIN faults f ON f.source = p.source WHERE f.problem IS NULL AND dedupe = 'newest') t WHERE q = 1 UNION ALL SELECT source, NULL, NULL, problem FROM faults WHERE problem IS NOT NULL", recipes=RECIPES, entered=ENTERED, offered=OFFERED, passing=PASSING, faults=FAULTS))
def enumerate_source(spark, sf_dir):
    k = F.col("k")
    nation = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("source"), F.col("n_nationkey").alias("k"))
    globs = F.when(k % 4 == 1, "*1*|*7").when(k % 4 == 2, "zzz*").when(k % 4 == 3, "http://a.b/*?2")
    recipes = nation.select("source", globs.alias("filter"), F.when(k % 8 == 7, "oldest").when(k % 5 == 0, "newest").alias("dedupe"))
    first = F.concat(F.lit("list"), (k % 3).cast("string"), F.when((k % 4 != 0) | (k == 8), "/").otherwise(""))
    entries = nation.select("source", F.explode(F.array(first, F.lit("more"))).alias("entry"))
    c = F.col("c_custkey")
    listing = table(spark, sf_dir, "customer").select(F.concat(F.lit("list"), (c % 3).cast("string"), F.lit("/")).alias("entry"), F.concat(F.lit("http://a.b/"), c.cast("string")).alias("url"), F.col("c_nationkey").alias("cell"), F.when(c % 3 != 1, F.col("c_acctbal")).alias("modified"))
    return registry.enumerate_source(recipes, entries, listing)


RAW = "SELECT 's' || CAST(o_custkey % 7 AS VARCHAR) AS source, 'f' || CAST(o_custkey AS VARCHAR) AS key, CASE WHEN min(o_custkey) % 2 = 0 THEN min(o_custkey) % 50 END AS cell, max(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END) AS value FROM orders WHERE o_orderstatus = '{}' GROUP BY 1, 2"


@query(with_views("SELECT q.source, q.key, CASE origin WHEN 'carried' THEN cell_key ELSE q.key END AS registered, CASE origin WHEN 'kept' THEN known WHEN 'read' THEN value ELSE cell_value END AS value, origin, origin IN ('kept', 'read') AS healthy, refused FROM (SELECT l.*, CASE WHEN p.key IS NOT NULL THEN 'kept' WHEN l.value IS NOT NULL THEN 'read' WHEN c.key IS NOT NULL THEN 'carried' ELSE 'broken' END AS origin, p.value AS known, c.key AS cell_key, c.value AS cell_value FROM raw_now l LEFT JOIN raw_before p ON p.source = l.source AND p.key = l.key LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, cell ORDER BY key DESC) AS n FROM raw_before WHERE cell IS NOT NULL) t WHERE n = 1) c ON c.source = l.source AND c.cell = l.cell) q JOIN (SELECT l.source, count(*) FILTER (p.key IS NULL AND l.value IS NULL) > 5 AS refused FROM raw_now l LEFT JOIN raw_before p ON p.source = l.source AND p.key = l.key GROUP BY 1) b ON b.source = q.source WHERE origin <> 'broken'", raw_now=RAW.format("O"), raw_before=RAW.format("F")))
def register_raw(spark, sf_dir):
    def rows(status):
        c = F.col("o_custkey")
        keyed = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == status).groupBy(F.concat(F.lit("s"), (c % 7).cast("string")).alias("source"), F.concat(F.lit("f"), c.cast("string")).alias("key"))
        return keyed.agg(F.when(F.min(c) % 2 == 0, F.min(c) % 50).alias("cell"), F.max(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey"))).alias("value"))

    return registry.register_raw(rows("O"), rows("F"))


@query("SELECT p_partkey, CASE WHEN declared = 'rar' THEN 'unknown format rar' WHEN declared IS NULL OR (declared = 'zip' AND kind = 'zip') OR (declared = 'asc-tile' AND kind IN ('zip', '7z')) OR (declared = 'tar.gz' AND kind = 'gzip') THEN NULL ELSE 'declared ' || declared || ', found ' || kind END AS problem FROM (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'zip' WHEN 1 THEN 'asc-tile' WHEN 2 THEN 'tar.gz' WHEN 3 THEN 'rar' END AS declared, CASE p_partkey % 4 WHEN 0 THEN 'zip' WHEN 1 THEN 'gzip' WHEN 2 THEN '7z' ELSE 'other' END AS kind FROM part) t")
def unpack_dispatch(spark, sf_dir):
    n, k = F.col("p_size") % 5, F.col("p_partkey") % 4
    declared = F.when(n == 0, "zip").when(n == 1, "asc-tile").when(n == 2, "tar.gz").when(n == 3, "rar")
    head = F.when(k == 0, "504B030414").when(k == 1, "1F8B08").when(k == 2, "377ABCAF271C00").otherwise("3C68746D6C")
    return table(spark, sf_dir, "part").select("p_partkey", registry.declared_problem(declared, F.unhex(head)).alias("problem"))


@query("SELECT key, problem FROM (SELECT p_partkey AS key, CASE WHEN p_partkey % 11 = 0 THEN 'missing' WHEN p_partkey % 7 = 0 THEN 'size' WHEN p_partkey % 13 = 0 AND p_partkey % 5 <> 0 THEN 'digest' END AS problem FROM part) t WHERE problem IS NOT NULL UNION ALL SELECT -s_suppkey, 'left over' FROM supplier WHERE s_suppkey <> 0")
def stage_parts(spark, sf_dir):
    """Parts as published and as staged; every eleventh is missing, every seventh longer, every thirteenth other bytes of that size."""
    k, text = F.col("p_partkey"), F.col("p_name")
    part = table(spark, sf_dir, "part")
    published = part.select(k.alias("key"), F.octet_length(text).cast("long").alias("size"), F.concat(F.upper(F.md5(text)), F.when(k % 5 == 0, "-3").otherwise("")).alias("etag"))
    other = F.when(k % 13 == 0, F.concat(F.lit("#"), text)).otherwise(text)
    staged = part.filter(k % 11 != 0).select(k.alias("key"), (F.octet_length(text) + F.when(k % 7 == 0, 1).otherwise(0)).cast("long").alias("size"), F.md5(other).alias("digest"))
    extra = table(spark, sf_dir, "supplier").filter("s_suppkey <> 0").select((-F.col("s_suppkey")).alias("key"), F.lit(1).cast("long").alias("size"), F.md5(F.lit("x")).alias("digest"))
    return registry.staged_parts(published, staged.unionByName(extra))


@query("SELECT t.stem, CASE WHEN c_custkey IS NOT NULL THEN 'tiles/' || t.stem END AS location, sources, priority, c_custkey IS NULL AS missing FROM (SELECT o.k, 't' || CAST(o.k AS VARCHAR) AS stem, string_agg(DISTINCT o.source, ',' ORDER BY o.source) AS sources, max(coalesce(n.priority, 0)) AS priority FROM (SELECT o_custkey AS k, 's' || CAST(o_orderkey % 7 AS VARCHAR) AS source FROM orders) o LEFT JOIN (SELECT 's' || CAST(n_nationkey AS VARCHAR) AS source, n_regionkey AS priority FROM nation WHERE n_nationkey < 6) n ON n.source = o.source GROUP BY 1, 2) t LEFT JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 13 <> 0) c ON c_custkey = t.k")
def write_index(spark, sf_dir):
    """The rows of an index, with what it would be refused for."""
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    tiled = table(spark, sf_dir, "orders").select(name("t", "o_custkey").alias("stem"), F.concat(F.lit("s"), (F.col("o_orderkey") % 7).cast("string")).alias("source"))
    there = table(spark, sf_dir, "customer").filter("c_custkey % 13 <> 0").select(name("t", "c_custkey").alias("stem"), name("tiles/t", "c_custkey").alias("location"))
    ranked = table(spark, sf_dir, "nation").filter("n_nationkey < 6").select(name("s", "n_nationkey").alias("source"), F.col("n_regionkey").alias("priority"))
    return tables.mosaic_index(tiled, there, ranked)


@query("SELECT 'p' || CAST(p_partkey AS VARCHAR) AS path, CASE WHEN p_partkey % 3 = 0 THEN 'unreadable' ELSE 'empty' END AS reason FROM part WHERE (p_partkey % 3 = 0 AND p_partkey % 7 = 0) OR (p_partkey % 3 = 1 AND p_size % 5 = 0)")
def verify_artifacts(spark, sf_dir):
    k = F.col("p_partkey")
    kind = F.when(k % 3 == 0, "tile").when(k % 3 == 1, "archive").otherwise("soundings")
    return tables.stranded(table(spark, sf_dir, "part").select(F.concat(F.lit("p"), k.cast("string")).alias("path"), kind.alias("kind"), (F.col("p_size") % 5).alias("size"), (k % 7 != 0).alias("readable")))


# Gates.

LAYERED = "SELECT 8 AS z, l_partkey % 16 AS x, l_suppkey % 16 AS y, l_returnflag AS layer, sum(l_linenumber) AS features FROM lineitem WHERE {} GROUP BY 1, 2, 3, 4"


@query(with_views("SELECT layer, count(*) AS compared, round(avg(abs(now - was) / CAST(greatest(was, 1) AS DOUBLE)), 9) AS mean_delta, max(abs(now - was) / CAST(greatest(was, 1) AS DOUBLE)) AS max_delta, max(now) = 0 AND max(was) > 0 AS absent FROM (SELECT coalesce(a.layer, b.layer) AS layer, coalesce(a.features, 0) AS was, coalesce(b.features, 0) AS now FROM (SELECT * FROM tiles_a WHERE (x, y) IN (SELECT (x, y) FROM tiles_b)) a FULL JOIN (SELECT * FROM tiles_b WHERE (x, y) IN (SELECT (x, y) FROM tiles_a)) b ON a.x = b.x AND a.y = b.y AND a.layer = b.layer) t GROUP BY 1", tiles_a=LAYERED.format("l_suppkey % 16 <> 5"), tiles_b=LAYERED.format("l_quantity > 10 AND l_returnflag <> 'N' AND l_suppkey % 16 <> 3")))
def ab_vector(spark, sf_dir):
    tile = [F.lit(8).alias("z"), (F.col("l_partkey") % 16).alias("x"), (F.col("l_suppkey") % 16).alias("y"), F.col("l_returnflag").alias("layer"), F.col("l_linenumber").alias("features")]
    rows = table(spark, sf_dir, "lineitem")
    found = gates.ab_vector(rows.filter("l_suppkey % 16 <> 5").select(*tile), rows.filter("l_quantity > 10 and l_returnflag <> 'N' and l_suppkey % 16 <> 3").select(*tile))
    return found.withColumn("mean_delta", F.round("mean_delta", 9))


@query(with_views("SELECT floor, cells, shallowest, cells - (SELECT count(*) FROM cells WHERE depth >= CAST(0.2 AS DOUBLE)) AS added FROM (SELECT floor, count(*) FILTER (depth >= floor) AS cells, min(depth) FILTER (depth >= floor) AS shallowest FROM cells, (SELECT CAST(f AS DOUBLE) AS floor FROM (VALUES (0.2), (1), (5), (10)) v(f)) w GROUP BY 1) t", cells=CELLS))
def gate_floor(spark, sf_dir):
    return gates.admitted_by_floor(merge.shoalest_cell(surface(spark, sf_dir), 3), [0.2, 1.0, 5.0, 10.0])
