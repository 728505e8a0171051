"""Queries of datum surfaces, seeds and plates, serving in batches, ordered rules, vector tiles and further gates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from soundgrid.operators import covering, datum, focal, gates, labels, merge, ordered, outlines, serving, tilechecks, triangulation, vectors, vectortiles
from soundgrid.queries import query
from soundgrid.queries.catalog import HW, SPLIT, STEMS, _spans, _stems
from soundgrid.queries.charting import BOXES, _boxes
from soundgrid.queries.surfaces import CELLS, MASKED, SIDES, _masked, blur_sql
from soundgrid.queries.views import EXTENT, SIDE, files, mask, points, px, surface, table, with_views


@query(with_views("SELECT coalesce(a.r, b.r) AS r, coalesce(a.c, b.c) AS c, coalesce(b.z, a.z) AS z, CASE WHEN b.z IS NOT NULL THEN 2 ELSE 1 END AS bias FROM (SELECT * FROM px WHERE src = 'A') a FULL JOIN (SELECT * FROM px WHERE src = 'R') b ON a.r = b.r AND a.c = b.c"))
def geoid_overlay(spark, sf_dir):
    p = px(spark, sf_dir)
    side = lambda s, k: p.filter(F.col("src") == s).select("r", "c", "z", F.lit(k).alias("bias"))
    return datum.geoid_overlay(side("A", 1), side("R", 2), ["r", "c"], ["z", "bias"])


@query(with_views("SELECT r, c, z FROM (SELECT r, c, z, row_number() OVER (PARTITION BY r, c ORDER BY CASE src WHEN 'A' THEN 3 WHEN 'N' THEN 1 ELSE 2 END, z) AS k FROM px) t WHERE k = 1"))
def region_mosaic(spark, sf_dir):
    area = F.when(F.col("src") == "A", 3).when(F.col("src") == "N", 1).otherwise(2)
    return datum.region_mosaic(px(spark, sf_dir).withColumn("area", area), ["r", "c"], "area", "z")


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN s - l WHEN 1 THEN CAST(1.5 AS DOUBLE) + CAST(0.25 AS DOUBLE) - CAST(1 AS DOUBLE) + (s - l) ELSE -l END AS value FROM (SELECT c_custkey, c_custkey % 17 / CAST(4 AS DOUBLE) AS s, c_custkey % 5 / CAST(2 AS DOUBLE) AS l FROM customer) t")
def ellipsoid_shift(spark, sf_dir):
    k = F.col("c_custkey")
    frame = F.when(k % 3 == 0, "tidal").when(k % 3 == 1, "ellipsoid").otherwise("island")
    return table(spark, sf_dir, "customer").select(k, datum.separation(frame, k % 17 / 4.0, k % 5 / 2.0, F.lit(1.5), F.lit(1.0), F.lit(0.25)).alias("value"))


LINE = [(0.0, 0.0, 1.0, 40.0, 30.0, 2.0), (40.0, 30.0, 2.0, 90.0, 60.0, 4.0), (90.0, 60.0, 4.0, 127.0, 127.0, 5.0)]


@query(with_views(f"SELECT id, round(CASE WHEN d <= 10 THEN v END, 9) AS value FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, v) AS k FROM (SELECT id, sqrt((x - x1 - t * (x2 - x1)) * (x - x1 - t * (x2 - x1)) + (y - y1 - t * (y2 - y1)) * (y - y1 - t * (y2 - y1))) AS d, v1 + t * (v2 - v1) AS v FROM (SELECT *, least(greatest(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), 0), 1) AS t FROM points, (SELECT CAST(a AS DOUBLE) AS x1, CAST(b AS DOUBLE) AS y1, CAST(c AS DOUBLE) AS v1, CAST(d AS DOUBLE) AS x2, CAST(e AS DOUBLE) AS y2, CAST(f AS DOUBLE) AS v2 FROM (VALUES {', '.join(map(str, LINE))}) l(a, b, c, d, e, f)) s) q) w) z WHERE k = 1"))
def corridor_fill(spark, sf_dir):
    line = spark.createDataFrame(LINE, "x1 double, y1 double, v1 double, x2 double, y2 double, v2 double")
    return datum.corridor_fill(points(spark, sf_dir), line, 10.0).select("id", F.round("value", 9).alias("value"))


@query(with_views("SELECT id, CASE WHEN x + y > 60 AND x + y < 140 AND x - y < 40 AND y - x < 40 THEN coalesce(CASE WHEN id % 2 = 0 THEN CAST(7 AS DOUBLE) END, CAST(1 AS DOUBLE)) ELSE CAST(1 AS DOUBLE) END AS value FROM points WHERE x + y NOT IN (60, 140) AND x - y NOT IN (40, -40)"))
def crd_override(spark, sf_dir):
    at = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
    ring = F.array(at(50.0, 10.0), at(90.0, 50.0), at(50.0, 90.0), at(10.0, 50.0))
    inner = points(spark, sf_dir).filter("x + y not in (60, 140) and x - y not in (40, -40)").withColumn("value", F.lit(1.0))
    return datum.override(inner, ring, F.when(F.col("id") % 2 == 0, 7.0)).select("id", "value")


@query(with_views('SELECT source, max(greatest((top - bottom) / width, (top - bottom) / height)) / CAST(100 AS DOUBLE) AS cells FROM files GROUP BY 1'))
def group_cell_px(spark, sf_dir):
    span = F.col("top") - F.col("bottom")
    return files(spark, sf_dir).groupBy("source").agg((F.max(F.greatest(span / F.col("width"), span / F.col("height"))) / F.lit(100.0)).alias("cells"))


TILE8 = "least(greatest(CAST(floor({v} / (2 * " + HW + " / 256)) AS INT), 0), 255)"


@query(with_views(f"SELECT x, y, source, string_agg(DISTINCT filename || ':' || CAST(maxzoom AS VARCHAR), ',' ORDER BY filename || ':' || CAST(maxzoom AS VARCHAR)) AS files FROM (SELECT p.*, CAST(a.i AS INT) AS x, CAST(b.i AS INT) AS y FROM parts p, range(256) a(i), range(256) b(i) WHERE a.i BETWEEN {TILE8.format(v='(\"left\" - 300 + ' + HW + ')')} AND {TILE8.format(v='(\"right\" + 300 + ' + HW + ')')} AND b.i BETWEEN {TILE8.format(v='(' + HW + ' - top - 300)')} AND {TILE8.format(v='(' + HW + ' - bottom + 300)')}) t GROUP BY 1, 2, 3", parts=SPLIT))
def macrotile_map(spark, sf_dir):
    return covering.macrotile_map(files(spark, sf_dir)).withColumn("files", F.array_join("files", ","))


@query(with_views("SELECT DISTINCT least(z, child_z - k) AS z, x >> (z - least(z, child_z - k)) AS x, y >> (z - least(z, child_z - k)) AS y, child_z - k AS child_z FROM stems, (SELECT CAST(i AS INT) AS k FROM range(32) t(i)) u WHERE k <= child_z", stems=STEMS))
def render_stems(spark, sf_dir):
    return covering.render_stems(_stems(spark, sf_dir))


ASKED = "SELECT 9 AS z, CAST(c_custkey % 512 AS INT) AS x, CAST(c_custkey * 7 % 512 AS INT) AS y FROM customer GROUP BY 1, 2, 3"


def _asked(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.lit(9).alias("z"), (F.col("c_custkey") % 512).cast("int").alias("x"), (F.col("c_custkey") * 7 % 512).cast("int").alias("y")).distinct()


PLANET = "SELECT DISTINCT 9 AS z, CAST(o_custkey % 512 AS INT) AS x, CAST(o_custkey * 7 % 512 AS INT) AS y FROM orders WHERE o_custkey % 3 = 0"


def _planet(spark, sf_dir):
    return table(spark, sf_dir, "orders").filter("o_custkey % 3 = 0").select(F.lit(9).alias("z"), (F.col("o_custkey") % 512).cast("int").alias("x"), (F.col("o_custkey") * 7 % 512).cast("int").alias("y")).distinct()


@query(with_views("SELECT a.z, a.x, a.y, CASE WHEN max(CASE WHEN p.z = 9 THEN 1 END) = 1 THEN 'planet' WHEN max(s.z) IS NOT NULL THEN 'overzoom' ELSE 'land' END AS answer, greatest(max(p.z), max(s.z)) AS found_z FROM asked a LEFT JOIN planet p ON p.x = a.x AND p.y = a.y LEFT JOIN stems s ON a.x >> (9 - s.z) = s.x AND a.y >> (9 - s.z) = s.y GROUP BY 1, 2, 3", asked=ASKED, planet=PLANET, stems=STEMS))
def serve_raster(spark, sf_dir):
    return serving.serve_raster(_asked(spark, sf_dir), _planet(spark, sf_dir), _stems(spark, sf_dir))


@query(with_views("SELECT a.z, a.x, a.y, CASE WHEN max(s.z) IS NULL THEN 204 ELSE 200 END AS status, max(s.z) AS found_z FROM asked a LEFT JOIN stems s ON a.x >> (9 - s.z) = s.x AND a.y >> (9 - s.z) = s.y GROUP BY 1, 2, 3", asked=ASKED, stems=STEMS))
def serve_vector(spark, sf_dir):
    return serving.serve_vector(_asked(spark, sf_dir), _stems(spark, sf_dir), 14)


@query("SELECT o_orderkey, CASE WHEN z < 0 OR x < 0 OR x >= 1 << z OR y >= 1 << z THEN 400 WHEN o_orderstatus = 'P' THEN 503 WHEN z > 8 THEN 404 ELSE 200 END AS status FROM (SELECT o_orderkey, o_orderstatus, CAST(o_orderkey % 11 AS INT) AS z, CAST(o_custkey % 300 - 5 AS INT) AS x, CAST(o_custkey % 77 AS INT) AS y FROM orders) t")
def tile_request_status(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    z, x, y = (F.col("o_orderkey") % 11).cast("int"), (F.col("o_custkey") % 300 - 5).cast("int"), (F.col("o_custkey") % 77).cast("int")
    return o.select("o_orderkey", serving.request_status(z, x, y, 8, F.col("o_orderstatus") != "P").alias("status"))


# Points, bent lines and boxes of a tile in the frame of a tile two zooms down, whose units are a quarter as long.
FRAMED = "SELECT p_partkey AS id, CAST(p_partkey % 3 + 1 AS INT) AS kind, (p_partkey * 37 % 4096) * 4 - 4096 AS x0, (p_partkey * 91 % 4096) * 4 - 8192 AS y0, (p_partkey * 37 % 4096 + p_partkey % 700 + 1) * 4 - 4096 AS x1, (p_partkey * 91 % 4096 + p_partkey % 500 + 1) * 4 - 8192 AS y1 FROM part"
WITHIN = "SELECT *, least(x1, 4176) - greatest(x0, -80) AS w, least(y1, 4176) - greatest(y0, -80) AS h FROM framed"


def _in_units(spark, sf_dir):
    """A parent tile's features: points, lines of two steps and boxes."""
    k = F.col("p_partkey")
    x, y, w, h = k * 37 % 4096, k * 91 % 4096, k % 700 + 1, k % 500 + 1
    at = lambda a, b: F.struct(a.cast("long").alias("x"), b.cast("long").alias("y"))
    line, box = [at(x, y), at(x + w, y), at(x + w, y + h)], [at(x, y), at(x + w, y), at(x + w, y + h), at(x, y + h)]
    parts = F.when(k % 3 == 0, F.array(F.array(at(x, y)))).when(k % 3 == 1, F.array(F.array(*line))).otherwise(F.array(F.array(*box)))
    tile = [F.lit(5).alias("z"), F.lit(9).alias("x"), F.lit(11).alias("y"), F.lit("marks").alias("layer")]
    return table(spark, sf_dir, "part").select(*tile, k.alias("id"), (k % 3 + 1).cast("int").alias("kind"), parts.alias("parts"), F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("brand"), F.concat(F.lit('"'), "p_brand", F.lit('"'))).alias("properties"))


@query(with_views("SELECT id, kind, 1 AS parts, 1 AS points, CAST(0 AS DOUBLE) AS measure FROM within WHERE kind = 1 AND x0 BETWEEN -80 AND 4176 AND y0 BETWEEN -80 AND 4176 UNION ALL SELECT id, kind, 1, 4, CAST(w * h AS DOUBLE) FROM within WHERE kind = 3 AND w > 0 AND h > 0 UNION ALL SELECT id, kind, 1, CASE WHEN f AND g THEN 3 ELSE 2 END, CAST(CASE WHEN f THEN w ELSE 0 END + CASE WHEN g THEN h ELSE 0 END AS DOUBLE) FROM (SELECT *, w > 0 AND y0 BETWEEN -80 AND 4176 AS f, h > 0 AND x1 BETWEEN -80 AND 4176 AS g FROM within WHERE kind = 2) t WHERE f OR g", framed=FRAMED, within=WITHIN))
def overzoom_synthesize(spark, sf_dir):
    """What a tile two zooms down shows of its ancestor's features: parts, points, and lengths or areas."""
    requests = table(spark, sf_dir, "region").filter("r_regionkey = 0").select(F.lit(7).alias("z"), F.lit(37).alias("x"), F.lit(46).alias("y"), F.lit(5).alias("found_z"))
    found = vectortiles.overzoomed(_in_units(spark, sf_dir), requests)
    part = F.col("parts")[0]
    step = lambda p, i: F.when(i > 0, F.abs(p["x"] - F.get(part, i - 1)["x"]) + F.abs(p["y"] - F.get(part, i - 1)["y"])).otherwise(0)
    length = F.aggregate(F.transform(part, step), F.lit(0).cast("long"), lambda s, v: s + v).cast("double")
    measure = F.when(F.col("kind") == 3, vectors.ring_area(part)).when(F.col("kind") == 2, length).otherwise(0.0)
    found = found.select("id", "kind", F.size("parts").alias("n"), F.size(F.flatten("parts")).alias("points"), measure.alias("measure"))
    return found.withColumnRenamed("n", "parts")


@query("SELECT 5 AS z, 9 AS x, 11 AS y, 'marks' AS layer, p_partkey AS id, CAST(p_partkey % 3 + 1 AS INT) AS kind, CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 4 END AS points, p_partkey * 37 % 4096 + CASE WHEN p_partkey % 3 = 1 THEN p_partkey % 700 + 1 ELSE 0 END AS last_x, p_partkey * 91 % 4096 + CASE WHEN p_partkey % 3 > 0 THEN p_partkey % 500 + 1 ELSE 0 END AS last_y, CAST(p_size AS VARCHAR) AS size, '\"' || p_brand || '\"' AS brand FROM part")
def tile_payload(spark, sf_dir):
    """Features packed into a payload and read from it again."""
    back = vectortiles.unpacked(vectortiles.packed(_in_units(spark, sf_dir)))
    last = F.element_at(F.col("parts")[0], -1)
    return back.select("z", "x", "y", "layer", "id", "kind", F.size(F.col("parts")[0]).alias("points"), last["x"].alias("last_x"), last["y"].alias("last_y"), F.col("properties")["size"].alias("size"), F.col("properties")["brand"].alias("brand"))


@query(with_views("SELECT id, (least(i + 1, 20.5::DOUBLE) - i) * (least(j + 1, 10.25::DOUBLE) - j) AS area FROM boxes WHERE i < 20.5 AND j < 10.25", boxes=BOXES))
def clip_bbox(spark, sf_dir):
    cut = _boxes(spark, sf_dir).withColumn("cut", vectors.clip_box(F.col("ring"), 0.0, 0.0, 20.5, 10.25)).filter(F.size("cut") > 2)
    return cut.select("id", vectors.ring_area(F.col("cut")).alias("area")).filter("area > 0")


THIN = "SELECT id, p_size % 5 AS k, CASE p_size % 5 WHEN 0 THEN CAST(1 AS DOUBLE) WHEN 1 THEN CAST(2e-9 AS DOUBLE) WHEN 2 THEN CAST(3e-10 AS DOUBLE) WHEN 3 THEN CAST(1.4e-9 AS DOUBLE) ELSE CAST(5e-11 AS DOUBLE) END AS w FROM boxes"


@query(with_views("SELECT id, CASE WHEN k IN (2, 4) THEN 2 ELSE 4 END AS vertices, round((w - CASE WHEN k IN (2, 4) THEN 0 WHEN k = 3 THEN CAST(1e-9 AS DOUBLE) ELSE w END) * 1e9, 3) AS lost, CASE k WHEN 2 THEN 'eaten' WHEN 4 THEN 'collapsed' END AS problem FROM thin", boxes=BOXES, thin=THIN))
def snap_write_grid(spark, sf_dir):
    """Boxes down to a twentieth of the grid's step wide: points that fall on the one before are dropped, and what a ring loses is told."""
    k, x, y = F.col("p_size") % 5, F.col("ring")[0]["x"], F.col("ring")[0]["y"]
    w = F.when(k == 0, 1.0).when(k == 1, 2e-9).when(k == 2, 3e-10).when(k == 3, 1.4e-9).otherwise(5e-11)
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    thin = _boxes(spark, sf_dir).select("id", F.array(at(x, y), at(x + w, y), at(x + w, y + 1.0), at(x, y + 1.0)).alias("ring"))
    found = vectors.snapped_within(thin, 9, 1e-10, 0.5)
    return found.select("id", F.size("ring").alias("vertices"), F.round(F.col("lost") * 1e9, 3).alias("lost"), "problem")


@query(with_views("SELECT z, x, y, count(*) AS features FROM (SELECT id, z, CAST(floor(px * pow(CAST(2 AS DOUBLE), z)) AS INT) AS x, CAST(floor(py * pow(CAST(2 AS DOUBLE), z)) AS INT) AS y FROM (SELECT id, x / 128 AS px, y / 128 AS py, CAST(id % 5 AS INT) AS minzoom, CASE WHEN id % 3 = 0 THEN CAST(id % 5 AS INT) END AS lastzoom FROM points) p, (SELECT CAST(i AS INT) AS z FROM range(9) t(i)) zs WHERE z >= minzoom AND z <= coalesce(lastzoom, 8)) q GROUP BY 1, 2, 3"))
def tile_features(spark, sf_dir):
    p = points(spark, sf_dir).select("id", *((F.col(a) / 128.0).alias(n) for a, n in (("x", "x0"), ("x", "x1"), ("y", "y0"), ("y", "y1"))), (F.col("id") % 5).cast("int").alias("minzoom"), F.when(F.col("id") % 3 == 0, (F.col("id") % 5).cast("int")).alias("lastzoom"))
    return vectors.feature_tiles(p, 8).groupBy("z", "x", "y").agg(F.count(F.lit(1)).alias("features"))


@query(with_views("SELECT id, chain, row_number() OVER (PARTITION BY chain ORDER BY CASE WHEN chain % 3 = 0 THEN -id ELSE id END) AS place, CAST(CASE WHEN chain % 3 = 0 THEN id + 1 ELSE id END AS DOUBLE) AS ax FROM (SELECT id, min(id) OVER (PARTITION BY id // 5) AS chain FROM segs) t", segs="SELECT p_partkey AS id FROM part"))
def line_merge(spark, sf_dir):
    """Chains of five segments each, in order; every third segment is given the other way round, and a chain runs the way of its least."""
    k = F.col("p_partkey")
    y, back = F.floor(k / 5).cast("double"), k % 3 == 0
    s = table(spark, sf_dir, "part").select(k.alias("id"), F.when(back, k + 1).otherwise(k).cast("double").alias("ax"), y.alias("ay"), F.when(back, k).otherwise(k + 1).cast("double").alias("bx"), y.alias("by"))
    return outlines.ordered_chains(s).select("id", "chain", F.row_number().over(Window.partitionBy("chain").orderBy("place")).alias("place"), "ax")


@query(with_views("SELECT id, round(lo, 9) AS ax, round(y + (lo - x), 9) AS ay, round(hi, 9) AS bx, round(y + (hi - x), 9) AS by FROM (SELECT id, x, y, greatest(x, 20, 10 - y + x) AS lo, least(x + 30, 90, 100 - y + x) AS hi FROM points) t WHERE lo <= hi"))
def clip_segments(spark, sf_dir):
    """Diagonal lines cut to a box, both ends, whatever side they cross."""
    p = points(spark, sf_dir).select("id", F.col("x").alias("ax"), F.col("y").alias("ay"), (F.col("x") + 30.0).alias("bx"), (F.col("y") + 30.0).alias("by"))
    cut = vectors.clip_segments(p, 20.0, 10.0, 90.0, 100.0)
    return cut.select("id", *(F.round(c, 9).alias(c) for c in ("ax", "ay", "bx", "by")))


# The world is 2^32 units wide; points, bent lines and boxes at the customers' places, from a zoom of their own on, to the seventh.
WORLDLY = "SELECT id, CAST(id % 3 + 1 AS INT) AS kind, CAST(id % 4 + 3 AS INT) AS minzoom, CASE WHEN id % 5 = 0 THEN CAST(id % 4 + 4 AS INT) END AS lastzoom, CAST(round(x / 128 * 4294967296) AS BIGINT) AS x0, CAST(round(y / 128 * 4294967296) AS BIGINT) AS y0, CAST(round((x + 1.5::DOUBLE) / 128 * 4294967296) AS BIGINT) AS x1, CAST(round((y + 0.75::DOUBLE) / 128 * 4294967296) AS BIGINT) AS y1 FROM points"
IN_TILES = "SELECT *, greatest(x0 - tx * s, -m) AS lx, least(x1 - tx * s, s + m) AS hx, greatest(y0 - ty * s, -m) AS ly, least(y1 - ty * s, s + m) AS hy FROM (SELECT *, 5 * s // 256 AS m FROM (SELECT w.*, z, CAST(4294967296 >> z AS BIGINT) AS s, i AS tx, j AS ty FROM worldly w, (SELECT CAST(i AS INT) AS z FROM range(3, 8) t(i)) zs, range(128) a(i), range(128) b(j) WHERE z >= minzoom AND z <= coalesce(lastzoom, 7) AND i < 1 << z AND j < 1 << z AND i BETWEEN (x0 >> (32 - z)) - 1 AND (x1 >> (32 - z)) + 1 AND j BETWEEN (y0 >> (32 - z)) - 1 AND (y1 >> (32 - z)) + 1) q) r"
UNITS = "CAST(floor(abs({0}) * CAST(4096 AS DOUBLE) / s + CAST(0.5 AS DOUBLE)) * sign({0}) AS BIGINT)"
NEAR_BOX = "SELECT id, kind, z, tx, ty, " + ", ".join(f"{UNITS.format(c)} AS {c}" for c in ("lx", "hx", "ly", "hy")) + ", x0 - tx * s AS qx, x1 - tx * s AS rx, y0 - ty * s AS qy, y1 - ty * s AS ry, s, m FROM in_tiles"


@query(with_views("SELECT z, tx AS x, ty AS y, id, kind, lx AS x0, ly AS y0, lx AS x1, ly AS y1 FROM near_box WHERE kind = 1 AND qx BETWEEN -m AND s + m AND qy BETWEEN -m AND s + m UNION ALL SELECT z, tx, ty, id, kind, lx, ly, hx, hy FROM near_box WHERE kind = 3 AND qx < s + m AND rx > -m AND qy < s + m AND ry > -m AND lx < hx AND ly < hy UNION ALL SELECT z, tx, ty, id, kind, CASE WHEN f THEN lx ELSE hx END, ly, hx, CASE WHEN g THEN hy ELSE ly END FROM (SELECT *, qy BETWEEN -m AND s + m AND qx <= s + m AND rx >= -m AND lx < hx AS f, rx BETWEEN -m AND s + m AND qy <= s + m AND ry >= -m AND ly < hy AS g FROM near_box WHERE kind = 2) t WHERE f OR g", worldly=WORLDLY, in_tiles=IN_TILES, near_box=NEAR_BOX))
def mvt_clip(spark, sf_dir):
    """The boxes of what all tiles show of points, lines of two steps and rings: cut to the buffered tile, in its units."""
    x, y = F.col("x") / 128.0, F.col("y") / 128.0
    right, down = (F.col("x") + 1.5) / 128.0, (F.col("y") + 0.75) / 128.0
    at = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    k = F.col("id") % 3
    parts = F.when(k == 0, F.array(F.array(at(x, y)))).when(k == 1, F.array(F.array(at(x, y), at(right, y), at(right, down)))).otherwise(F.array(F.array(at(x, y), at(x, down), at(right, down), at(right, y))))
    p = points(spark, sf_dir).select("id", F.lit("marks").alias("layer"), (k + 1).cast("int").alias("kind"), parts.alias("parts"), F.create_map(F.lit("n"), F.col("id").cast("string")).alias("properties"), (F.col("id") % 4 + 3).cast("int").alias("minzoom"), F.when(F.col("id") % 5 == 0, (F.col("id") % 4 + 4).cast("int")).alias("lastzoom"))
    found = vectortiles.tiled(p, 7)
    ends = lambda f, k: f(F.transform(F.flatten("parts"), lambda p: p[k]))
    return found.select("z", "x", "y", "id", "kind", ends(F.array_min, "x").alias("x0"), ends(F.array_min, "y").alias("y0"), ends(F.array_max, "x").alias("x1"), ends(F.array_max, "y").alias("y1"))


PLACED = "SELECT g.r, g.c, t.z, CASE t.src WHEN 'R' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS place, t.z IS NOT NULL AS there, coalesce(t.z, 0) AS v FROM (SELECT CAST(a.i AS INT) AS r, CAST(b.i AS INT) AS c FROM range(128) a(i), range(128) b(i)) g LEFT JOIN (SELECT r, c, z, src FROM (SELECT r, c, z, px.src AS src, row_number() OVER (PARTITION BY r, c ORDER BY priority DESC, maxzoom DESC, px.src) AS k FROM px JOIN srcs ON px.src = srcs.src) q WHERE k = 1) t ON t.r = g.r AND t.c = g.c"
RIM = f"SELECT p.r, p.c, CASE WHEN s.r IS NULL THEN CAST(0 AS DOUBLE) ELSE 1 END AS v FROM placed p LEFT JOIN (SELECT a.r, a.c FROM placed a, (VALUES {SIDES}) d(dr, dc), placed b WHERE b.r = a.r + dr AND b.c = a.c + dc AND a.there AND b.there GROUP BY a.r, a.c, a.place HAVING count(*) = 4 AND max(b.place) > a.place) s ON s.r = p.r AND s.c = p.c"
MIRROR = "CASE WHEN {x} < 0 THEN -1 - {x} WHEN {x} > 127 THEN 255 - {x} ELSE {x} END"
FEATHERED = "SELECT r, c, z, round(CASE WHEN z >= 0 AND blend < 0 THEN z ELSE blend END, 6) AS feathered FROM (SELECT r, c, z, (t * t * (3 - 2 * t)) * m + (1 - t * t * (3 - 2 * t)) * z AS blend FROM (SELECT p.r, p.c, p.z, m.v AS m, least(n.v * sqrt(2 * pi()) * 2, 1) AS t FROM placed p JOIN means m ON m.r = p.r AND m.c = p.c JOIN nearness n ON n.r = p.r AND n.c = p.c WHERE p.there) a) b"


@query(with_views(FEATHERED, placed=PLACED, rim=RIM, **blur_sql("means", "placed", 2.0, MIRROR), **blur_sql("nearness", "rim", 2.0, MIRROR)))
def seam_feather(spark, sf_dir):
    from soundgrid.queries.views import sources

    merged = merge.priority_fill(px(spark, sf_dir), sources(spark), ["r", "c"])
    rank = F.when(F.col("src") == "R", 1).when(F.col("src") == "N", 2).otherwise(3)
    return focal.seam_feather(merged, rank, EXTENT, size=32).select("r", "c", "z", F.round("feathered", 6).alias("feathered"))


@query()
def gate_connectivity(spark, sf_dir):
    """Ponds are filled, and a belt of deeper water is raised, which closes channels."""
    s = surface(spark, sf_dir)
    raised = s.withColumn("z", F.when(F.col("r").between(40, 44) & (F.col("z") < -4), 3.0).otherwise(F.col("z")))
    return gates.connectivity(s, labels.pond_fill(raised, 12, 6), EXTENT)


SEAM = "SELECT (CASE WHEN z < -20 THEN 3 WHEN z < -10 THEN 2 WHEN z < 0 THEN 1 ELSE 0 END) AS band, r AS p FROM surface WHERE c = {c}"


@query(with_views(f"SELECT band, CAST(min(p) AS INT) AS lo, CAST(max(p) + 1 AS INT) AS hi FROM (SELECT band, p, p - row_number() OVER (PARTITION BY band ORDER BY p) AS g FROM ((({SEAM.format(c=63)}) EXCEPT ({SEAM.format(c=64)})) UNION (({SEAM.format(c=64)}) EXCEPT ({SEAM.format(c=63)}))) q) t GROUP BY band, g"))
def seam_depare(spark, sf_dir):
    """Where two tiles disagree on the bands along their common edge."""
    from soundgrid.operators.intervals import interval_difference

    z = F.col("z")
    band = F.when(z < -20, 3).when(z < -10, 2).when(z < 0, 1).otherwise(0).alias("band")
    side = lambda c: surface(spark, sf_dir).filter(F.col("c") == c).select(band, F.col("r").alias("lo"), (F.col("r") + 1).alias("hi"))
    return interval_difference(side(63), side(64), ["band"])


# Ordered rules.


@query()
def match_1d(spark, sf_dir):
    side = lambda s: _spans(spark, sf_dir, s).select("edge", F.col("lo").cast("double").alias("p")).distinct()
    return ordered.match_sorted(side("A"), side("R"), ["edge"], 1.0)


SIZED = "SELECT o_custkey % 20 AS source, o_orderkey AS name, CAST(floor(o_totalprice) AS BIGINT) AS size, row_number() OVER (PARTITION BY o_custkey % 20 ORDER BY o_orderkey) AS k FROM orders"


@query(with_views("SELECT source, name, size, batch FROM filling", sized=SIZED, filling="SELECT source, name, size, k, size AS used, CAST(0 AS INT) AS batch FROM sized WHERE k = 1 UNION ALL SELECT s.source, s.name, s.size, s.k, CASE WHEN f.used + s.size > 5000000 THEN s.size ELSE f.used + s.size END, CASE WHEN f.used + s.size > 5000000 THEN f.batch + 1 ELSE f.batch END FROM filling f JOIN sized s ON s.source = f.source AND s.k = f.k + 1"))
def plan_batches(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 20).alias("source"), F.col("o_orderkey").alias("name"), F.floor("o_totalprice").alias("size"))
    return ordered.plan_batches(o, ["source"], 5_000_000)


@query()
def tile_priority(spark, sf_dir):
    return ordered.tile_priority(_stems(spark, sf_dir).select("stem", (F.col("child_z") - F.col("z")).alias("weight")))


# Interpolation over triangles. The SQL tries all triples of nodes with the reach; a triangle counts if no node is in its circle, by the sign of the
# determinant, which doubles hold exactly for halves of pixels; of nodes on one circle the first by x and y counts as lifted.

REACH, NEAR = 40.0, 14.0
NODES = "SELECT (r >> 4) * 16 + (r >> 4) * 5 % 7 + CAST(0.5 AS DOUBLE) AS y, (c >> 4) * 16 + (r >> 4) * 3 % 5 + CAST(0.5 AS DOUBLE) AS x, -max(z) AS v FROM surface WHERE z < 0 AND (r >> 4) % 3 + (c >> 4) % 4 < 4 GROUP BY r >> 4, c >> 4"
NUMBERED = "SELECT row_number() OVER (ORDER BY x, y) AS i, x, y, v FROM nodes"
TRIPLES = f"""SELECT * FROM (SELECT *, sqrt(ux * ux + uy * uy) * sqrt(vx * vx + vy * vy) * sqrt((ux - vx) * (ux - vx) + (uy - vy) * (uy - vy)) / (2 * abs(det)) AS radius FROM (
    SELECT a.x AS x0, a.y AS y0, a.v AS v0, b.x - a.x AS ux, b.y - a.y AS uy, b.v - a.v AS uv, c.x - a.x AS vx, c.y - a.y AS vy, c.v - a.v AS vv, (b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) AS det, a.i, b.i AS j, c.i AS k
    FROM numbered a JOIN numbered b ON b.i > a.i AND abs(b.x - a.x) <= {2 * REACH} AND abs(b.y - a.y) <= {2 * REACH} JOIN numbered c ON c.i > b.i AND abs(c.x - a.x) <= {2 * REACH} AND abs(c.y - a.y) <= {2 * REACH}) t WHERE abs(det) > CAST(1e-9 AS DOUBLE)) t WHERE radius <= {REACH}"""
# With the triangle's first node as the origin: the other node's height over the plane through the lifted three, times the determinant, and its share of the first node.
CIRCLES = "SELECT t.*, n.i AS n, ((wx * wx + wy * wy) * det - (wx * vy - wy * vx) * (ux * ux + uy * uy) - (ux * wy - uy * wx) * (vx * vx + vy * vy)) * sign(det) AS height, 1 - (wx * vy - wy * vx + ux * wy - uy * wx) / det AS share FROM (SELECT t.*, n.i AS n0, n.x - t.x0 AS wx, n.y - t.y0 AS wy FROM triples t JOIN numbered n ON n.i <> t.i AND n.i <> t.j AND n.i <> t.k AND abs(n.x - t.x0) <= 4 * radius AND abs(n.y - t.y0) <= 4 * radius) t JOIN numbered n ON n.i = n0"
FACES = "SELECT * FROM triples t WHERE NOT EXISTS (SELECT 1 FROM circles c WHERE c.i = t.i AND c.j = t.j AND c.k = t.k AND (height < 0 OR (height = 0 AND n > t.i AND share > 0)))"


def on_faces_sql(places: str) -> str:
    """``places`` with x and y, each with what the triangles around say, and the least of it."""
    return f"SELECT id, min(v0 + p * uv + q * vv) AS value FROM (SELECT s.id, ((s.x - x0) * vy - (s.y - y0) * vx) / det AS p, ((s.y - y0) * ux - (s.x - x0) * uy) / det AS q, v0, uv, vv FROM {places} s, faces) t WHERE p >= -1e-9 AND q >= -1e-9 AND p + q <= 1 + 1e-9 GROUP BY id"


TRIANGLES = {"nodes": NODES, "numbered": NUMBERED, "triples": TRIPLES, "circles": CIRCLES, "faces": FACES}


def _nodes(spark, sf_dir):
    """The least depth of squares of 16 pixels, a third of them without one, at places of their own."""
    r, c = F.shiftright("r", 4), F.shiftright("c", 4)
    kept = surface(spark, sf_dir).filter((F.col("z") < 0) & (r % 3 + c % 4 < 4)).groupBy(r.alias("i"), c.alias("j")).agg((-F.max("z")).alias("v"))
    return kept.select((F.col("j") * 16 + F.col("i") * 3 % 5 + 0.5).alias("x"), (F.col("i") * 16 + F.col("i") * 5 % 7 + 0.5).alias("y"), "v")


NEAREST = f"SELECT points.id FROM points JOIN nodes ON (points.x - nodes.x) * (points.x - nodes.x) + (points.y - nodes.y) * (points.y - nodes.y) <= {NEAR * NEAR} GROUP BY points.id"


@query(with_views("SELECT points.id, round(CASE WHEN k.id IS NOT NULL THEN f.value END, 6) AS value FROM points LEFT JOIN on_faces f ON f.id = points.id LEFT JOIN nearest k ON k.id = points.id", on_faces=on_faces_sql("points"), nearest=NEAREST, **TRIANGLES))
def delaunay_interpolate(spark, sf_dir):
    """Blocks of 64 pixels; at every size of the tables, places are dealt to them and the nodes around come along."""
    found = triangulation.interpolate(points(spark, sf_dir), _nodes(spark, sf_dir), REACH, NEAR, size=64.0)
    return found.select("id", F.round("value", 6).alias("value"))


WET = "SELECT r * 128 + c AS id, c + CAST(0.5 AS DOUBLE) AS x, r + CAST(0.5 AS DOUBLE) AS y, z FROM surface WHERE z < 0 AND r % 2 = 0 AND c % 2 = 0"


@query(with_views("SELECT count(*) AS sampled, count(*) FILTER (short > 1e-6) AS violating, round(coalesce(count(*) FILTER (short > 1e-6) / CAST(nullif(count(*), 0) AS DOUBLE), 0), 9) AS share, round(coalesce(max(short), 0), 6) AS worst FROM (SELECT value + z AS short FROM on_faces f JOIN wet ON wet.id = f.id) t", wet=WET, on_faces=on_faces_sql("wet"), **TRIANGLES))
def interp_violation(spark, sf_dir):
    gate = triangulation.interpolation_gate(surface(spark, sf_dir), _nodes(spark, sf_dir), REACH, stride=2, size=64.0)
    return gate.select("sampled", "violating", F.round("share", 9).alias("share"), F.round("worst", 6).alias("worst"))


def _sounded(spark, sf_dir):
    """Tiles of 32 by 32 pixels with their ground, and soundings: the least depths of squares of 16 pixels at zoom 10, of 8 pixels at 11."""
    tiled = surface(spark, sf_dir).filter("z < 0").withColumns({"tile_r": F.shiftright("r", 5), "tile_c": F.shiftright("c", 5)})
    tile = ["tile_r", "tile_c"]

    def lattice(bits: int, zoom: int):
        best = tiled.groupBy(*tile, F.shiftright("r", bits).alias("i"), F.shiftright("c", bits).alias("j")).agg(F.max(F.struct("z", -F.col("r"), -F.col("c"))).alias("s"))
        return best.select(*tile, (0.5 - F.col("s.col3")).alias("x"), (0.5 - F.col("s.col2")).alias("y"), (-F.col("s.z")).alias("v"), F.lit(zoom).alias("minzoom"), F.lit(True).alias("lattice"))

    return tiled, lattice(4, 10).unionByName(lattice(3, 11))


@query()
def repair_soundings(spark, sf_dir):
    """Where the ground, to 200 m, is deeper than the displayed soundings imply by over 2 m and half its depth, worst first and apart."""
    ground, soundings = _sounded(spark, sf_dir)
    return triangulation.repaired_soundings(ground, soundings, ["tile_r", "tile_c"], (10, 11), spacing=4.0)


# Seeds and plates.


def _land(spark, sf_dir):
    return mask(spark, sf_dir).filter("tidal").select("r", "c")


def _seeds(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("seed"), (F.col("n_nationkey") * 5 % 128).cast("int").alias("r"), (F.col("n_nationkey") * 29 % 128).cast("int").alias("c"))


SEEDS = "SELECT n_nationkey AS seed, CAST(n_nationkey * 5 % 128 AS INT) AS r, CAST(n_nationkey * 29 % 128 AS INT) AS c FROM nation"


@query(with_views("SELECT seed, r, c FROM flood", seeds=SEEDS, wetland="SELECT r, c FROM mask WHERE tidal", flood=f"SELECT seed, s.r, s.c FROM seeds s JOIN wetland w ON w.r = s.r AND w.c = s.c UNION SELECT f.seed, w.r, w.c FROM flood f, (VALUES {SIDES}) d(dr, dc), wetland w WHERE w.r = f.r + dr AND w.c = f.c + dc"))
def flood_component(spark, sf_dir):
    return labels.flood_component(_land(spark, sf_dir), _seeds(spark, sf_dir))


@query(with_views("SELECT seed, r, c FROM (SELECT s.seed, m.r, m.c, row_number() OVER (PARTITION BY s.seed ORDER BY (s.r - m.r) * (s.r - m.r) + (s.c - m.c) * (s.c - m.c), m.r, m.c) AS k FROM seeds s JOIN mask m ON m.tidal AND (s.r - m.r) * (s.r - m.r) + (s.c - m.c) * (s.c - m.c) <= 36) t WHERE k = 1", seeds=SEEDS))
def resolve_components(spark, sf_dir):
    return labels.resolve_seeds(_land(spark, sf_dir), _seeds(spark, sf_dir)).select("seed", "r", "c")


@query()
def drop_plates(spark, sf_dir):
    flat = merge.shoal_reduce(surface(spark, sf_dir), 1).withColumn("z", F.round("z"))
    return labels.drop_plates(flat, least=6)


# Gates.


@query(with_views("SELECT count(*) AS points, count(*) FILTER (d IS NULL) AS alone, round(quantile_cont(d, 0.25), 9) AS p25, round(quantile_cont(d, 0.5), 9) AS p50, round(quantile_cont(d, 0.75), 9) AS p75 FROM (SELECT a.id, min(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS d FROM points a LEFT JOIN points b ON a.id <> b.id AND b.x BETWEEN a.x - 2 AND a.x + 2 AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 2 GROUP BY a.id) t"))
def gate_density(spark, sf_dir):
    out = gates.density(points(spark, sf_dir), 2.0)
    return out.select("points", "alone", *(F.round(c, 9).alias(c) for c in ("p25", "p50", "p75")))


# Boxes of three to nine pixels as closed isobaths of a level of their own; some lie in others.
RINGED = "SELECT id, CAST(p_size % 6 * 4 AS DOUBLE) AS level, i * 3 AS x0, j * 3 AS y0, i * 3 + 3 + 3 * (p_size % 3) AS x1, j * 3 + 3 + 3 * (p_size % 3) AS y1 FROM boxes WHERE p_size % 6 > 0"


@query(with_views("SELECT id, level, shoalest, NOT EXISTS (SELECT 1 FROM points p WHERE p.x > t.x0 AND p.x < t.x1 AND p.y > t.y0 AND p.y < t.y1) AS bare FROM (SELECT g.id, g.level, g.x0, g.x1, g.y0, g.y1, -max(s.z) AS shoalest FROM ringed g JOIN surface s ON s.c >= g.x0 AND s.c < g.x1 AND s.r >= g.y0 AND s.r < g.y1 WHERE s.z < 0 GROUP BY ALL) t WHERE shoalest < level - CAST(0.05 AS DOUBLE)", boxes=BOXES, ringed=RINGED))
def gate_rings(spark, sf_dir):
    """Closed isobaths around shoals, and those of them without a sounding inside."""
    b = _boxes(spark, sf_dir).filter("p_size % 6 > 0")
    x0, y0, side = F.col("ring")[0]["x"] * 3.0, F.col("ring")[0]["y"] * 3.0, F.lit(3.0) + F.col("p_size") % 3 * 3.0
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    rings = b.select("id", (F.col("p_size") % 6 * 4).cast("double").alias("level"), F.array(at(x0, y0), at(x0 + side, y0), at(x0 + side, y0 + side), at(x0, y0 + side)).alias("ring"))
    # Soundings on a ring's edge may count either way; a nudge decides it.
    soundings = points(spark, sf_dir).select(*(F.when(F.col(c) == F.floor(c), F.lit(-1.0)).otherwise(F.col(c)).alias(c) for c in ("x", "y")))
    return gates.bare_rings(rings, surface(spark, sf_dir), soundings, SIDE)


@query("SELECT s_nationkey AS nation, s_suppkey, s_acctbal AS value, abs(s_acctbal - m) AS residual FROM supplier LEFT JOIN (SELECT c_nationkey, max(c_acctbal) AS m FROM customer WHERE c_nationkey <> 3 GROUP BY 1) c ON s_nationkey = c_nationkey WHERE m IS NULL OR abs(s_acctbal - m) > 5000")
def benchmark_gate(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey", F.col("s_acctbal").alias("value"))
    c = table(spark, sf_dir, "customer").filter("c_nationkey <> 3").groupBy(F.col("c_nationkey").alias("nation")).agg(F.max("c_acctbal").alias("value"))
    return gates.residuals(s, c, ["nation"], 5000.0)


@query("SELECT coalesce(a.k, b.k) AS k, a.n AS now, b.n AS due, CASE WHEN a.n IS NULL THEN 'missing' WHEN b.n IS NULL THEN 'unexpected' ELSE 'count' END AS wrong FROM (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_nationkey <> 2 GROUP BY 1) a FULL JOIN (SELECT c_nationkey AS k, count(*) // 15 AS n FROM customer WHERE c_nationkey <> 5 GROUP BY 1) b ON a.k = b.k WHERE a.n IS NULL OR b.n IS NULL OR abs(a.n - b.n) > b.n * CAST(0.5 AS DOUBLE)")
def coverage_gate(spark, sf_dir):
    now = table(spark, sf_dir, "supplier").filter("s_nationkey <> 2").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    due = table(spark, sf_dir, "customer").filter("c_nationkey <> 5").groupBy(F.col("c_nationkey").alias("k")).agg(F.floor(F.count(F.lit(1)) / 15).alias("n"))
    return gates.expected_regions(now, due, "k", "n", 0.5)


CATALOGS = "SELECT s_suppkey AS source, CASE WHEN s_suppkey % 9 <> 2 THEN s_name END AS name, CASE WHEN s_suppkey % 7 = 3 THEN '  ' ELSE s_name END AS license, coalesce(l, 0) + CASE WHEN s_suppkey % 5 = 1 THEN 1 ELSE 0 END AS l, coalesce(h, 0) AS h, coalesce(n, 0) + CASE WHEN s_suppkey % 11 = 4 THEN 1 ELSE 0 END AS n FROM supplier LEFT JOIN recounted ON source = s_suppkey"
RECOUNTED = "SELECT l_suppkey AS source, min(l_partkey) AS l, max(l_partkey) AS h, count(*) AS n FROM lineitem WHERE l_suppkey % 13 <> 6 GROUP BY 1"


@query(with_views("SELECT source, 'lacks' AS problem, CASE WHEN name IS NULL AND trim(license) = '' THEN 'name,license' WHEN name IS NULL THEN 'name' ELSE 'license' END AS detail FROM catalogs WHERE name IS NULL OR trim(license) = '' UNION ALL SELECT c.source, 'bbox', CASE WHEN r.source IS NULL THEN NULL ELSE '{\"l\":' || CAST(r.l AS VARCHAR) || ',\"h\":' || CAST(r.h AS VARCHAR) || '}' END FROM catalogs c LEFT JOIN recounted r ON r.source = c.source WHERE r.source IS NULL OR c.l <> r.l OR c.h <> r.h UNION ALL SELECT c.source, 'count', CAST(coalesce(r.n, 0) AS VARCHAR) FROM catalogs c LEFT JOIN recounted r ON r.source = c.source WHERE c.n <> coalesce(r.n, 0) UNION ALL SELECT l_suppkey, CASE WHEN l_linenumber = 7 THEN 'missing file' WHEN l_returnflag = 'R' AND l_partkey % 50 = 0 THEN 'no crs' ELSE 'no nodata' END, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) FROM lineitem WHERE l_suppkey % 3 <> 0 AND (l_linenumber = 7 OR (l_returnflag = 'R' AND l_partkey % 50 = 0) OR l_partkey % 70 = 1)", catalogs=CATALOGS, recounted=RECOUNTED))
def source_contract(spark, sf_dir):
    """Catalogs against what their files say: values, boxes, counts, rasters."""
    files = table(spark, sf_dir, "lineitem")
    box = F.struct(F.min("l_partkey").alias("l"), F.max("l_partkey").alias("h"))
    recounted = files.filter("l_suppkey % 13 <> 6").groupBy(F.col("l_suppkey").alias("source")).agg(box.alias("bbox"), F.count(F.lit(1)).alias("count"))
    k = F.col("source")
    told = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source"), "s_name").join(recounted, "source", "left")
    zero = F.lit(0).cast("long")
    bbox = F.struct((F.coalesce("bbox.l", zero) + F.when(k % 5 == 1, 1).otherwise(0)).alias("l"), F.coalesce("bbox.h", zero).alias("h"))
    catalogs = told.select("source", F.when(k % 9 != 2, F.col("s_name")).alias("name"), F.when(k % 7 == 3, "  ").otherwise(F.col("s_name")).alias("license"), bbox.alias("bbox"), (F.coalesce("count", zero) + F.when(k % 11 == 4, 1).otherwise(0)).alias("count"))
    name = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    rasters = files.select(F.col("l_suppkey").alias("source"), name.alias("filename"), (F.col("l_linenumber") != 7).alias("there"), F.when(~((F.col("l_returnflag") == "R") & (F.col("l_partkey") % 50 == 0)), "EPSG:3857").alias("crs"), F.when(F.col("l_partkey") % 70 != 1, -9999.0).alias("nodata"), (F.col("l_suppkey") % 3 == 0).alias("remote"))
    return gates.contract(catalogs, ["name", "license"], recounted, rasters)


@query(with_views("SELECT 'dropped' AS problem, id FROM boxes WHERE id % 17 = 4 UNION ALL SELECT 'dry', p.id FROM points p WHERE p.id % 3 = 0 AND p.x BETWEEN 2 AND 38 AND p.y BETWEEN 0 AND 40 AND NOT EXISTS (SELECT 1 FROM boxes b WHERE b.id % 17 <> 4 AND b.i < p.x + 0.25 AND b.i + 1 > p.x - 0.25 AND b.j < p.y + 0.25 AND b.j + 1 > p.y - 0.25)", boxes=BOXES))
def water_gate(spark, sf_dir):
    """Water that a conversion dropped, and required probes that have none near."""
    eligible = _boxes(spark, sf_dir)
    probes = points(spark, sf_dir).withColumn("required", F.col("id") % 3 == 0)
    windows = table(spark, sf_dir, "region").filter("r_regionkey < 2").select((F.col("r_regionkey") * 18.0 + 2.0).alias("west"), F.lit(0.0).alias("south"), (F.col("r_regionkey") * 18.0 + 20.0).alias("east"), F.lit(40.0).alias("north"))
    return gates.water_gate(eligible, eligible.filter("id % 17 <> 4"), probes, windows, 0.25)


SHIFTED = "SELECT r >> 4 AS tr, c >> 4 AS tc, z * 60 AS a, z * 60 + CASE WHEN land THEN c % 5 ELSE (r % 3) * CAST(0.5 AS DOUBLE) END AS b FROM masked"
TILED = "SELECT avg(abs(a - b)) AS mean_abs, avg(a) < -300 AS deep, count(*) FILTER (abs(a - b) > 1) / CAST(count(*) AS DOUBLE) AS share FROM shifted GROUP BY tr, tc"


@query(with_views("SELECT count(*) AS compared, count(*) FILTER (deep) AS deep, round(max(share), 9) AS over, " + ", ".join(f"round(coalesce(quantile_cont(mean_abs, {p}) FILTER ({'' if n == 'deep' else 'NOT '}deep), 0), 9) AS {n}_{c}" for n in ("deep", "other") for c, p in (("median", 0.5), ("p95", 0.95))) + ", coalesce(quantile_cont(mean_abs, 0.95) FILTER (deep), 0) > CAST(0.55 AS DOUBLE) AS failed FROM tiled", masked=MASKED, shifted=SHIFTED, tiled=TILED))
def ab_terrain(spark, sf_dir):
    """Two builds of the ground by tiles of 16 pixels: deep ones may hardly differ."""
    a = F.col("z") * 60.0
    b = a + F.when(F.col("land"), F.col("c") % 5).otherwise(F.col("r") % 3 * 0.5)
    pixels = _masked(spark, sf_dir).select(F.shiftright("r", 4).alias("tr"), F.shiftright("c", 4).alias("tc"), a.alias("a"), b.alias("b"))
    found = gates.ab_terrain(pixels, ["tr", "tc"], deep=-300.0, most=0.55)
    return found.withColumns({c: F.round(c, 9) for c in ("over", "deep_median", "deep_p95", "other_median", "other_p95")})


# Boxes as bands of tiles: eight by eight in a tile at zoom 5, four by four at zoom 6, where some are left out and some reach over the next.
IN_SIX = "SELECT *, id % 31 = 7 AND (id + 1) % 29 <> 5 AS wide FROM boxes WHERE id % 29 <> 5"
FULL = "SELECT x, y FROM (SELECT DISTINCT i // 8 AS x, j // 8 AS y, i // 4 AS a, j // 4 AS b FROM in_six) t GROUP BY 1, 2 HAVING count(*) = 4"


@query(with_views("SELECT 'lost' AS problem, CAST(5 AS BIGINT) AS z, f.x, f.y, NULL AS layer, NULL AS id, CAST(512 * 512 * count(*) AS DOUBLE) AS value FROM boxes b JOIN full_tiles f ON f.x = b.i // 8 AND f.y = b.j // 8 WHERE b.id % 29 = 5 GROUP BY f.x, f.y UNION ALL SELECT 'overlap', 6, a.i // 4, a.j // 4, NULL, a.id, CAST(300 * 1024 AS DOUBLE) FROM in_six a JOIN in_six b ON b.i = a.i + 1 AND b.j = a.j AND a.wide AND a.i // 4 = b.i // 4 UNION ALL SELECT 'early', 5, i // 8, j // 8, 'bands', id, NULL FROM boxes WHERE id % 41 = 3 UNION ALL SELECT 'absent', NULL, NULL, NULL, 'bands', p_partkey, NULL FROM part WHERE p_partkey % 7 = 3 UNION ALL SELECT 'no soundings', NULL, NULL, NULL, NULL, NULL, NULL", boxes=BOXES, in_six=IN_SIX, full_tiles=FULL))
def selfcheck_vector(spark, sf_dir):
    b = _boxes(spark, sf_dir).select("id", F.col("ring")[0]["x"].cast("long").alias("i"), F.col("ring")[0]["y"].cast("long").alias("j"))
    at = lambda a, c: F.struct(a.cast("long").alias("x"), c.cast("long").alias("y"))

    def shown(df, z: int, n: int, more=F.lit(0)):
        u = 4096 // n
        x0, y0 = F.col("i") % n * u, F.col("j") % n * u
        ring = F.array(at(x0, y0), at(x0 + u + more, y0), at(x0 + u + more, y0 + u), at(x0, y0 + u))
        return df.select(F.lit(z).alias("z"), F.floor(F.col("i") / n).alias("x"), F.floor(F.col("j") / n).alias("y"), F.lit("bands").alias("layer"), "id", F.lit(3).alias("kind"), F.array(ring).alias("parts"))

    wide = F.when((F.col("id") % 31 == 7) & ((F.col("id") + 1) % 29 != 5), 300).otherwise(0)
    features = shown(b, 5, 8).unionByName(shown(b.filter("id % 29 <> 5"), 6, 4, wide))
    expected = table(spark, sf_dir, "part").select(F.lit("bands").alias("layer"), F.col("p_partkey").alias("id"))
    first = F.when(F.col("id") % 41 == 3, 6).otherwise(5)
    return tilechecks.selfcheck(features, expected, first, F.col("layer") == "bands")
