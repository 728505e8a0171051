"""Queries of the surface operators: layering, transforms, roll-ups, neighbourhoods, components."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundgrid.functions import depth
from soundgrid.operators import focal, gates, labels, merge, outlines
from soundgrid.operators.polygons import polygon_area, polygon_rim
from soundgrid.plans.chart import classified_tiles
from soundgrid.queries import query
from soundgrid.queries.views import EXTENT, SIDE, mask, points, px, sources, surface, table, with_views

D = "CAST({} AS DOUBLE)"


def quantize_sql(z: str, zoom: int) -> str:
    """The quantizer in SQL."""
    step = f"least({D.format(repr(depth.quantization_factor(zoom)))}, pow(CAST(2 AS DOUBLE), ceil(log2(greatest(abs({z}) / CAST(16 AS DOUBLE), CAST(0.25 AS DOUBLE))))))"
    up = f"(ceil({z} / {step}) * {step} + CAST(0 AS DOUBLE))"
    return f"(CASE WHEN {z} < 0 AND {up} >= 0 THEN CAST(-0.00390625 AS DOUBLE) ELSE {up} END)"


def band_sql(z: str, levels: list[float]) -> str:
    return "(" + " + ".join(f"CASE WHEN {z} >= {D.format(repr(v))} THEN 1 ELSE 0 END" for v in levels) + ")"


@query(with_views("SELECT r, c, z, src FROM (SELECT r, c, z, px.src AS src, row_number() OVER (PARTITION BY r, c ORDER BY priority DESC, maxzoom DESC, px.src) AS k FROM px JOIN srcs ON px.src = srcs.src) t WHERE k = 1"))
def priority_fill(spark, sf_dir):
    return merge.priority_fill(px(spark, sf_dir), sources(spark), ["r", "c"])


RANKED = "SELECT 's' || CAST(s_suppkey % 97 AS VARCHAR) AS src, CAST(s_nationkey % 4 AS INT) AS priority, CAST(s_suppkey % 7 + 6 AS INT) AS maxzoom FROM supplier"


def _ranked(spark, sf_dir):
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), (k % 97).cast("string")).alias("src"), (F.col("s_nationkey") % 4).cast("int").alias("priority"), (k % 7 + 6).cast("int").alias("maxzoom"))


@query(with_views("SELECT src, priority, maxzoom, dense_rank() OVER (ORDER BY priority DESC, maxzoom DESC, src) AS place FROM ranked", ranked=RANKED))
def group_ranked(spark, sf_dir):
    return merge.group_ranked(_ranked(spark, sf_dir))


@query(with_views("SELECT src, max(priority) AS priority, max(maxzoom) AS maxzoom FROM ranked GROUP BY src ORDER BY priority DESC, maxzoom DESC, src", ranked=RANKED))
def order_sources(spark, sf_dir):
    known = _ranked(spark, sf_dir).groupBy("src").agg(F.max("priority").alias("priority"), F.max("maxzoom").alias("maxzoom"))
    return known.orderBy(F.desc("priority"), F.desc("maxzoom"), "src")


@query(with_views("SELECT r, c, count(*) AS layers, count(*) < 3 AS incomplete FROM px GROUP BY r, c"))
def contains_nodata(spark, sf_dir):
    return px(spark, sf_dir).groupBy("r", "c").agg(F.count(F.lit(1)).alias("layers"), (F.count(F.lit(1)) < 3).alias("incomplete"))


REDUCED = "SELECT r >> {n} AS r, c >> {n} AS c, coalesce(max(z) FILTER (z <= 16), max(z)) AS z FROM surface GROUP BY 1, 2"


@query(with_views(REDUCED.format(n=1)))
def shoal_reduce(spark, sf_dir):
    return merge.shoal_reduce(surface(spark, sf_dir))


@query(with_views("SELECT r >> 1 AS r, c >> 1 AS c, coalesce(max(z) FILTER (z <= 16), max(z)) AS z FROM (SELECT r >> 1 AS r, c >> 1 AS c, coalesce(max(z) FILTER (z <= 16), max(z)) AS z FROM half GROUP BY 1, 2) t GROUP BY 1, 2", half=REDUCED.format(n=1)))
def uniform_coarsen(spark, sf_dir):
    """Three halvings in one step; the SQL takes them one by one."""
    return merge.shoal_reduce(surface(spark, sf_dir), 3)


@query(with_views(" UNION ALL ".join(f"SELECT {n} AS level, r, c, z FROM ({REDUCED.format(n=n)}) t{n}" for n in range(5))))
def shoal_pyramid(spark, sf_dir):
    return merge.shoal_pyramid(surface(spark, sf_dir), 4).select("level", "r", "c", "z")


@query(with_views("SELECT m.r, m.c, greatest(m.z, f.z) AS z FROM (SELECT r >> 1 AS r, c >> 1 AS c, avg(z) AS z FROM surface GROUP BY 1, 2) m LEFT JOIN (SELECT r >> 1 AS r, c >> 1 AS c, max(z) AS z FROM surface WHERE z < 0 GROUP BY 1, 2) f ON m.r = f.r AND m.c = f.c"))
def finer_clamp(spark, sf_dir):
    fine = surface(spark, sf_dir)
    means = fine.groupBy(F.shiftright("r", 1).alias("r"), F.shiftright("c", 1).alias("c")).agg(F.avg("z").alias("z"))
    return merge.finer_clamp(means, fine)


CELLS = "SELECT cell_r, cell_c, -z AS depth, r, c FROM (SELECT r >> 3 AS cell_r, c >> 3 AS cell_c, z, r, c, row_number() OVER (PARTITION BY r >> 3, c >> 3 ORDER BY z DESC, r, c) AS k FROM surface WHERE z < 0) t WHERE k = 1 AND -z >= CAST(0.2 AS DOUBLE)"


@query(with_views(CELLS))
def shoalest_grid(spark, sf_dir):
    return merge.shoalest_cell(surface(spark, sf_dir), 3)


@query(with_views("SELECT cell_r >> 1 AS cell_r, cell_c >> 1 AS cell_c, min(depth) AS depth FROM cells GROUP BY 1, 2", cells=CELLS))
def reduce_shoalest(spark, sf_dir):
    return merge.sounding_pyramid(merge.shoalest_cell(surface(spark, sf_dir), 3), 1).filter("level = 1").select("cell_r", "cell_c", "depth")


@query(with_views("SELECT level, r AS cell_r, c AS cell_c, depth, pr AS r, pc AS c FROM (SELECT level, cell_r >> level AS r, cell_c >> level AS c, depth, cells.r AS pr, cells.c AS pc, row_number() OVER (PARTITION BY level, cell_r >> level, cell_c >> level ORDER BY depth, cells.r, cells.c) AS k FROM cells, (VALUES (0), (1), (2), (3)) l(level)) t WHERE k = 1", cells=CELLS))
def sounding_pyramid(spark, sf_dir):
    return merge.sounding_pyramid(merge.shoalest_cell(surface(spark, sf_dir), 3), 3)


# Scalar transforms.


def _raw(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("d"), (F.lit(20.0) - F.col("l_quantity") - F.col("l_linenumber") / 4.0).alias("z"))


RAW = "SELECT l_orderkey, l_linenumber, l_quantity AS d, CAST(20 AS DOUBLE) - l_quantity - l_linenumber / CAST(4 AS DOUBLE) AS z FROM lineitem"
KEYS = ("l_orderkey", "l_linenumber")


@query(with_views("SELECT l_orderkey, l_linenumber, -d AS z FROM raw", raw=RAW))
def negate_depth(spark, sf_dir):
    return _raw(spark, sf_dir).select(*KEYS, depth.negate_depth(F.col("d")).alias("z"))


@query(with_views("SELECT l_orderkey, l_linenumber, z + CAST(1.25 AS DOUBLE) AS z FROM raw", raw=RAW))
def datum_offset(spark, sf_dir):
    return _raw(spark, sf_dir).select(*KEYS, depth.datum_offset(F.col("z"), 1.25).alias("z"))


@query(with_views("SELECT l_orderkey, l_linenumber, CASE WHEN z <= 0 THEN z END AS z FROM raw", raw=RAW))
def clamp_positive(spark, sf_dir):
    return _raw(spark, sf_dir).select(*KEYS, depth.clamp_positive(F.col("z")).alias("z"))


@query(with_views("SELECT l_orderkey, l_linenumber, CASE WHEN z BETWEEN -20 AND 5 THEN z END AS z FROM raw", raw=RAW))
def valid_range(spark, sf_dir):
    return _raw(spark, sf_dir).select(*KEYS, depth.valid_range(F.col("z"), -20, 5).alias("z"))


@query(with_views("SELECT l_orderkey, l_linenumber, CASE WHEN z > -25 THEN z END AS z FROM raw", raw=RAW))
def mask_sentinels(spark, sf_dir):
    return _raw(spark, sf_dir).select(*KEYS, depth.mask_sentinels(F.col("z"), -25).alias("z"))


@query(with_views("SELECT s.r, s.c, s.z - coalesce(m.v, 0) AS z, m.v IS NOT NULL AS corrected FROM surface s LEFT JOIN (SELECT r >> 3 AS r, c >> 3 AS c, CAST(count(*) AS DOUBLE) / 64 AS v FROM mask GROUP BY 1, 2) m ON s.r >> 3 = m.r AND s.c >> 3 = m.c"))
def datum_surface_subtract(spark, sf_dir):
    ref = mask(spark, sf_dir).groupBy(F.shiftright("r", 3).alias("rr"), F.shiftright("c", 3).alias("rc")).agg((F.count(F.lit(1)).cast("double") / 64).alias("v"))
    s = surface(spark, sf_dir).withColumn("rr", F.shiftright("r", 3)).withColumn("rc", F.shiftright("c", 3)).join(ref, ["rr", "rc"], "left")
    return s.select("r", "c", (F.col("z") - F.coalesce("v", F.lit(0.0))).alias("z"), F.col("v").isNotNull().alias("corrected"))


@query(with_views("SELECT s.r, s.c, CASE WHEN t <= 0 AND t BETWEEN -30 AND 10 THEN t END AS z FROM (SELECT s.r, s.c, s.z + CAST(0.5 AS DOUBLE) - CASE WHEN m.tidal THEN CAST(0.25 AS DOUBLE) ELSE 0 END AS t FROM surface s LEFT JOIN mask m ON s.r = m.r AND s.c = m.c) s"))
def value_transform(spark, sf_dir):
    s = surface(spark, sf_dir).join(mask(spark, sf_dir), ["r", "c"], "left")
    ref = F.when(F.col("tidal"), F.lit(0.25))
    return s.select("r", "c", depth.value_transform(F.col("z"), False, 0.5, ref, True, -30, 10).alias("z"))


def _masked(spark, sf_dir):
    m = mask(spark, sf_dir)
    return surface(spark, sf_dir).join(m, ["r", "c"], "left").withColumns({"land": F.coalesce("land", F.lit(False)), "tidal": F.coalesce("tidal", F.lit(False))})


MASKED = "SELECT s.r, s.c, s.z, coalesce(m.land, false) AS land, coalesce(m.tidal, false) AS tidal FROM surface s LEFT JOIN mask m ON s.r = m.r AND s.c = m.c"


@query(with_views("SELECT r, c, CASE WHEN land AND z < 0 THEN 0 ELSE z END AS z FROM masked", masked=MASKED))
def land_clamp(spark, sf_dir):
    return _masked(spark, sf_dir).select("r", "c", depth.land_clamp(F.col("z"), F.col("land")).alias("z"))


@query(with_views("SELECT r, c, CASE WHEN tidal AND NOT land AND z > 0 THEN NULL ELSE z END AS z FROM masked", masked=MASKED))
def lake_clear(spark, sf_dir):
    return _masked(spark, sf_dir).select("r", "c", depth.lake_clear(F.col("z"), F.col("tidal") & ~F.col("land")).alias("z"))


@query(with_views("SELECT a.r, a.c, CASE WHEN a.z > 0 AND NOT a.tidal AND EXISTS (SELECT 1 FROM masked b WHERE b.tidal AND (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) <= 4 AND b.r BETWEEN a.r - 2 AND a.r + 2) THEN 0 ELSE a.z END AS z FROM masked a", masked=MASKED))
def ocean_clamp(spark, sf_dir):
    """Ground above the datum within two pixels of open water, but not in it, is at the datum."""
    near = focal.distance_to(_masked(spark, sf_dir), F.col("tidal"), 2, size=32)
    return near.select("r", "c", F.when((F.col("z") > 0) & ~F.col("tidal") & F.col("distance").isNotNull(), 0.0).otherwise(F.col("z")).alias("z"))


@query(with_views("SELECT r, c, CASE WHEN z < 0 AND (land OR EXISTS (SELECT 1 FROM masked b WHERE b.land AND abs(a.r - b.r) + abs(a.c - b.c) = 1)) THEN 0 ELSE z END AS z FROM masked a", masked=MASKED))
def dem_land_clamp(spark, sf_dir):
    """Land clamp with the mask grown by the pixels that touch its sides."""
    near = focal.distance_to(_masked(spark, sf_dir), F.col("land"), 1, size=32)
    return near.select("r", "c", depth.land_clamp(F.col("z"), F.col("distance").isNotNull()).alias("z"))


@query("SELECT o_orderkey, CAST(o_orderkey % 20 AS INT) AS zoom, CAST(524288 >> CAST(o_orderkey % 20 AS INT) AS DOUBLE) / 256 AS factor FROM orders")
def quantization_factor(spark, sf_dir):
    zoom = (F.col("o_orderkey") % 20).cast("int")
    return table(spark, sf_dir, "orders").select("o_orderkey", zoom.alias("zoom"), depth.quantization_factor_of(zoom).alias("factor"))


@query(with_views(" UNION ALL ".join(f"SELECT l_orderkey, l_linenumber, {zoom} AS zoom, {quantize_sql('z', zoom)} AS q FROM raw" for zoom in (0, 8, 12, 15)), raw=RAW))
def quantize(spark, sf_dir):
    raw, out = _raw(spark, sf_dir), None
    many = raw.withColumn("zoom", F.explode(F.array(*(F.lit(z) for z in (0, 8, 12, 15)))))
    for zoom in (0, 8, 12, 15):
        q = F.when(F.col("zoom") == zoom, depth.quantize(F.col("z"), zoom))
        out = q if out is None else F.coalesce(out, q)
    return many.select(*KEYS, "zoom", out.alias("q"))


@query(with_views(f"SELECT r, c, CAST(floor(w / 256) AS INT) AS red, CAST(w % 256 AS INT) AS green, CAST(round((h - w) * 256) AS INT) AS blue, h - 32768 AS z FROM (SELECT r, c, h, CAST(floor(h) AS BIGINT) AS w FROM (SELECT r, c, {quantize_sql('z', 12)} + CAST(32768 AS DOUBLE) AS h FROM surface) a) b"))
def terrarium_encode(spark, sf_dir):
    """Encoded and decoded again."""
    q = surface(spark, sf_dir).withColumn("q", depth.quantize(F.col("z"), 12))
    red, green, blue = depth.terrarium_encode(F.col("q"))
    coded = q.select("r", "c", red.alias("red"), green.alias("green"), blue.alias("blue"))
    return coded.withColumn("z", depth.terrarium_decode(F.col("red"), F.col("green"), F.col("blue")))


@query(with_views("SELECT r, c, CAST(n >> 16 AS INT) AS red, CAST((n >> 8) & 255 AS INT) AS green, CAST(n & 255 AS INT) AS blue FROM (SELECT r, c, least(greatest(CAST(floor((z + 32768) * 256 + CAST(0.5 AS DOUBLE)) AS BIGINT), 0), 16777215) AS n FROM surface) t"))
def terrarium_pack(spark, sf_dir):
    red, green, blue = depth.terrarium_pack(F.col("z"))
    return surface(spark, sf_dir).select("r", "c", red.alias("red"), green.alias("green"), blue.alias("blue"))


@query(with_views("SELECT r, c, CASE WHEN z IS NULL THEN 0 WHEN z > 0 AND NOT land AND z <= 16 THEN 1 WHEN z > 0 OR land THEN 2 ELSE 0 END AS code, CASE WHEN z > 0 THEN 2 ELSE 0 END AS bare FROM masked", masked=MASKED))
def classify_pixel(spark, sf_dir):
    return _masked(spark, sf_dir).select("r", "c", depth.classify_pixel(F.col("z"), F.col("land")).alias("code"), depth.classify_pixel(F.col("z"), None).alias("bare"))


@query(with_views("SELECT r, c, CASE WHEN land THEN CAST(2 AS DOUBLE) WHEN z >= 2 THEN 0 ELSE z END AS h FROM masked", masked=MASKED))
def mask_composite(spark, sf_dir):
    return _masked(spark, sf_dir).select("r", "c", F.when(F.col("land"), 2.0).when(F.col("z") >= 2, 0.0).otherwise(F.col("z")).alias("h"))


@query(with_views("SELECT r, c, z FROM masked WHERE z > 0 AND z <= 16 AND (NOT land OR tidal)", masked=MASKED))
def drying_cut(spark, sf_dir):
    return _masked(spark, sf_dir).filter((F.col("z") > 0) & (F.col("z") <= depth.DRYING_CAP) & (~F.col("land") | F.col("tidal"))).select("r", "c", "z")


@query(with_views("SELECT s.r, s.c, s.z FROM surface s LEFT JOIN mask m ON s.r = m.r AND s.c = m.c WHERE m.r IS NULL"))
def nodata_difference(spark, sf_dir):
    return surface(spark, sf_dir).join(mask(spark, sf_dir), ["r", "c"], "left_anti").select("r", "c", "z")


COARSE = "SELECT DISTINCT src, CAST(r >> 1 AS INT) AS r, CAST(c >> 1 AS INT) AS c FROM px"
QUADS = "SELECT src, sum(CASE WHEN n IN (1, 3) THEN 1 WHEN n = 2 AND m = 3 THEN 2 ELSE 0 END) AS corners FROM (SELECT src, r + dr AS r, c + dc AS c, count(*) AS n, sum(2 * dr + dc) AS m FROM coarse, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) d(dr, dc) GROUP BY 1, 2, 3) q GROUP BY 1"


@query(with_views("SELECT t.src, CAST(cells AS DOUBLE) AS area, CAST(4 * cells - 2 * coalesce(pairs, 0) AS DOUBLE) AS rim, CAST(corners AS BIGINT) AS corners FROM (SELECT src, count(*) AS cells FROM coarse GROUP BY 1) t JOIN quads q ON q.src = t.src LEFT JOIN (SELECT a.src, count(*) AS pairs FROM coarse a, (VALUES (0, 1), (1, 0)) d(dr, dc), coarse b WHERE b.src = a.src AND b.r = a.r + dr AND b.c = a.c + dc GROUP BY 1) p ON p.src = t.src", coarse=COARSE, quads=QUADS))
def dissolve_footprint(spark, sf_dir):
    """Each source's outlines: area, rim and corners; the SQL has them from counts of cells, of neighbours and of cells around points."""
    cells = px(spark, sf_dir).select("src", F.shiftright("r", 1).alias("r"), F.shiftright("c", 1).alias("c"))
    found = outlines.footprints(cells, ["src"], size=16)
    points = F.size("ring") + F.aggregate("holes", F.lit(0), lambda s, h: s + F.size(h))
    sums = [F.sum(polygon_area(found)).alias("area"), F.sum(polygon_rim(found)).alias("rim"), F.sum(points.cast("long")).alias("corners")]
    return found.groupBy("src").agg(*sums)


# Neighbourhoods.


@query(with_views("SELECT r, count(*) FILTER (cut) AS crossings FROM (SELECT r, lag(c) OVER w = c - 1 AND (lag(z) OVER w < -5) <> (z < -5) AS cut FROM surface WINDOW w AS (PARTITION BY r ORDER BY c)) t GROUP BY r"))
def crossings(spark, sf_dir):
    return focal.crossings(surface(spark, sf_dir), -5.0)


LEVELS = [float(v) for v in depth.ladder()]


@query(with_views(f"""SELECT a.r, a.c, a.side, l.level FROM (
    SELECT a.r, b.c AS c, 'h' AS side, least(a.k, b.k) AS low, greatest(a.k, b.k) AS high FROM banded a JOIN banded b ON a.r = b.r AND b.c = a.c + 1
    UNION ALL SELECT b.r, a.c, 'v', least(a.k, b.k), greatest(a.k, b.k) FROM banded a JOIN banded b ON a.c = b.c AND b.r = a.r + 1) a
    JOIN (VALUES {", ".join(f"({k + 1}, CAST({v!r} AS DOUBLE))" for k, v in enumerate(LEVELS))}) l(k, level) ON l.k > a.low AND l.k <= a.high""", banded=f"SELECT r, c, {band_sql('-z', LEVELS)} AS k FROM surface"), name="level_lines")
def level_lines(spark, sf_dir):
    """The raster form of isobaths: the edges between pixels of different bands."""
    return focal.band_edges(surface(spark, sf_dir), LEVELS)


# The eight triangles of each pixel, and the share of each that lies above a level.
OFFSETS = ", ".join(f"({k}, {i}, {j})" for k, (dx, dy) in enumerate(((1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1))) for i, j in sorted({(0, 0), (dx, 0), (0, dy), (dx, dy)}))
AROUND = f"SELECT s.r, s.c, s.z, k, avg(n.z) AS v FROM surface s, (VALUES {OFFSETS}) o(k, dx, dy), surface n WHERE n.r = s.r + dy AND n.c = s.c + dx GROUP BY s.r, s.c, s.z, k"
THIRDS = "SELECT least(p, q, s) AS lo, greatest(least(p, q), least(greatest(p, q), s)) AS mid, greatest(p, q, s) AS hi FROM (SELECT -a.z AS p, -a.v AS q, -b.v AS s FROM around a JOIN around b ON b.r = a.r AND b.c = a.c AND b.k = (a.k + 1) % 8) t"
ABOVE = f"SELECT k, sum(CASE WHEN level <= lo THEN 0 WHEN level >= hi THEN 1 WHEN level < mid THEN (level - lo) * (level - lo) / ((mid - lo) * (hi - lo)) ELSE 1 - (hi - level) * (hi - level) / ((hi - lo) * (hi - mid)) END) / 8 AS area FROM thirds, (VALUES {', '.join(f'({k}, {D.format(repr(v))})' for k, v in enumerate(LEVELS))}) l(k, level) GROUP BY k"


@query(with_views(f"SELECT CAST(k AS INT) AS band, round(area, 6) AS area FROM (SELECT k, area - coalesce(lag(area) OVER (ORDER BY k), 0) AS area FROM (SELECT k, area FROM above UNION ALL SELECT {len(LEVELS)}, count(*) FROM surface) t) u WHERE area > 1e-9", around=AROUND, thirds=THIRDS, above=ABOVE))
def band_partition(spark, sf_dir):
    """The areas of the bands' polygons, holes left out; the SQL adds up what lies between levels in each triangle."""
    found = outlines.band_polygons(surface(spark, sf_dir), LEVELS, size=32)
    return found.groupBy("band").agg(F.round(F.sum(polygon_area(found)), 6).alias("area"))


@query(with_views("SELECT a.r, a.c, round(sqrt(min(CAST((a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) AS DOUBLE))), 9) AS distance FROM surface a JOIN surface b ON b.z > 15 AND b.r BETWEEN a.r - 3 AND a.r + 3 AND b.c BETWEEN a.c - 3 AND a.c + 3 AND (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) <= 9 GROUP BY a.r, a.c"))
def distance_to_water(spark, sf_dir):
    near = focal.distance_to(surface(spark, sf_dir), F.col("z") > 15, 3, size=32)
    return near.filter("distance is not null").select("r", "c", F.round("distance", 9).alias("distance"))


HOLED = "SELECT g.r, g.c, s.z FROM (SELECT CAST(a.i AS INT) AS r, CAST(b.i AS INT) AS c FROM range(128) a(i), range(128) b(i)) g LEFT JOIN surface s ON s.r = g.r AND s.c = g.c AND s.z < 12"


def _holed(spark, sf_dir):
    grid = spark.range(128 * 128).select(F.floor(F.col("id") / 128).cast("int").alias("r"), (F.col("id") % 128).cast("int").alias("c"))
    return grid.join(surface(spark, sf_dir).filter("z < 12"), ["r", "c"], "left")


@query(with_views("SELECT r, c, filled FROM (SELECT a.r, a.c, coalesce(a.z, b.z) AS filled, row_number() OVER (PARTITION BY a.r, a.c ORDER BY (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c), b.r, b.c) AS k FROM holed a LEFT JOIN (SELECT * FROM holed WHERE z IS NOT NULL) b ON b.r BETWEEN a.r - 2 AND a.r + 2 AND b.c BETWEEN a.c - 2 AND a.c + 2 AND (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) <= 4) t WHERE k = 1", holed=HOLED))
def nearest_fill(spark, sf_dir):
    return focal.nearest_fill(_holed(spark, sf_dir), 2, size=32).select("r", "c", "filled")


@query(with_views("SELECT p.id, round(CASE WHEN count(s.z) = 4 THEN sum(w * s.z) END, 9) AS value FROM (SELECT id, floor(y) + i AS r, floor(x) + j AS c, CASE WHEN i = 1 THEN y - floor(y) ELSE 1 - (y - floor(y)) END * CASE WHEN j = 1 THEN x - floor(x) ELSE 1 - (x - floor(x)) END AS w FROM points, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j)) p LEFT JOIN surface s ON s.r = p.r AND s.c = p.c GROUP BY p.id"))
def bilinear_sample(spark, sf_dir):
    return focal.bilinear_sample(points(spark, sf_dir), surface(spark, sf_dir)).select("id", F.round("value", 9).alias("value"))


BSPLINE = "CASE {k} WHEN 0 THEN (1 - {t}) * (1 - {t}) * (1 - {t}) / 6 WHEN 1 THEN (3 * {t} * {t} * {t} - 6 * {t} * {t} + 4) / 6 WHEN 2 THEN (-3 * {t} * {t} * {t} + 3 * {t} * {t} + 3 * {t} + 1) / 6 ELSE {t} * {t} * {t} / 6 END"


@query(with_views(f"SELECT p.id, round(sum(w * s.z) / sum(w), 9) AS value FROM (SELECT id, least(greatest(floor(y) + i - 1, 0), 127) AS r, least(greatest(floor(x) + j - 1, 0), 127) AS c, ({BSPLINE.format(k='i', t='(y - floor(y))')}) * ({BSPLINE.format(k='j', t='(x - floor(x))')}) AS w FROM points, (VALUES (0), (1), (2), (3)) a(i), (VALUES (0), (1), (2), (3)) b(j)) p JOIN surface s ON s.r = p.r AND s.c = p.c GROUP BY p.id"))
def cubic_bspline_overzoom(spark, sf_dir):
    return focal.bspline_sample(points(spark, sf_dir), surface(spark, sf_dir), 128).select("id", F.round("value", 9).alias("value"))


@query(with_views("""SELECT r, c, round(degrees(atan(sqrt(gx * gx + gy * gy))), 6) AS slope FROM (SELECT r, c,
    CASE WHEN w IS NULL AND e IS NULL THEN 0 ELSE (coalesce(e, z) - coalesce(w, z)) / ((CASE WHEN w IS NULL THEN 0 ELSE 1 END + CASE WHEN e IS NULL THEN 0 ELSE 1 END) * CAST(10 AS DOUBLE)) END AS gx,
    CASE WHEN n IS NULL AND s IS NULL THEN 0 ELSE (coalesce(s, z) - coalesce(n, z)) / ((CASE WHEN n IS NULL THEN 0 ELSE 1 END + CASE WHEN s IS NULL THEN 0 ELSE 1 END) * CAST(10 AS DOUBLE)) END AS gy
    FROM (SELECT a.r, a.c, a.z, w.z AS w, e.z AS e, n.z AS n, s.z AS s FROM surface a LEFT JOIN surface w ON w.r = a.r AND w.c = a.c - 1 LEFT JOIN surface e ON e.r = a.r AND e.c = a.c + 1 LEFT JOIN surface n ON n.c = a.c AND n.r = a.r - 1 LEFT JOIN surface s ON s.c = a.c AND s.r = a.r + 1) t) g"""))
def slope(spark, sf_dir):
    return focal.slope(surface(spark, sf_dir), 10.0, block=32).select("r", "c", F.round("slope", 6).alias("slope"))


#: All cells of the grid with the water's height, ground and missing ones at the datum.
WORK = "SELECT g.r, g.c, CASE WHEN s.z < 0 THEN s.z ELSE 0 END AS v FROM (SELECT CAST(a.i AS INT) AS r, CAST(b.i AS INT) AS c FROM range(128) a(i), range(128) b(i)) g LEFT JOIN surface s ON s.r = g.r AND s.c = g.c"


def taps_sql(sigma: float) -> str:
    reach = int(4 * sigma + 0.5)
    return f"SELECT k, w / sum(w) OVER () AS w FROM (SELECT CAST(i AS INT) AS k, exp(CAST(-0.5 AS DOUBLE) * i * i / {sigma * sigma}) AS w FROM range(-{reach}, {reach} + 1) t(i)) q"


def blur_sql(name: str, source: str, sigma: float, at: str = "least(greatest({x}, 0), 127)") -> dict[str, str]:
    """Views that blur ``source(r, c, v)`` along rows and then columns; ``at`` says which cell stands for one beyond the edge."""
    line = "SELECT g.r, g.c, sum(t.w * b.v) AS v FROM {of} g, {name}_taps t, {of} b WHERE b.{keep} = g.{keep} AND b.{move} = {cell} GROUP BY g.r, g.c"
    one = lambda of, keep, move: line.format(of=of, name=name, keep=keep, move=move, cell=at.format(x=f"(g.{move} + t.k)"))
    return {f"{name}_taps": taps_sql(sigma), f"{name}_rows": one(source, "r", "c"), name: one(f"{name}_rows", "c", "r")}


@query(with_views("SELECT s.r, s.c, round(b.v, 6) AS mean FROM surface s JOIN blur b ON s.r = b.r AND s.c = b.c", work=WORK, **blur_sql("blur", "work", focal.LIGHT)))
def gauss_light(spark, sf_dir):
    return focal.water_blur(surface(spark, sf_dir), focal.LIGHT, EXTENT, size=32).select("r", "c", F.round("mean", 6).alias("mean"))


@query(with_views("SELECT s.r, s.c, round(b.v, 6) AS mean FROM surface s JOIN blur b ON s.r = b.r AND s.c = b.c", work=WORK, **blur_sql("blur", "work", focal.HEAVY)))
def gauss_heavy(spark, sf_dir):
    return focal.water_blur(surface(spark, sf_dir), focal.HEAVY, EXTENT, size=64).select("r", "c", F.round("mean", 6).alias("mean"))


#: Kernels for a grid of 128 cells, and slopes and depths for its relief.
SMALL = {"light": 1.0, "heavy": 2.0, "feather": 1.0, "flat": 0.2, "steep": 1.2, "shallow": 5.0, "deep": 20.0}
ANGLE = """SELECT g.r, g.c, 1 - least(greatest((degrees(atan(sqrt(gx * gx + gy * gy))) - 0.2) / CAST(1.0 AS DOUBLE), 0), 1) AS v FROM (
    SELECT g.r, g.c, (e.v - w.v) / ((e.c - w.c) * CAST(500 AS DOUBLE)) AS gx, (s.v - n.v) / ((s.r - n.r) * CAST(500 AS DOUBLE)) AS gy FROM work g
    JOIN work e ON e.r = g.r AND e.c = least(g.c + 1, 127) JOIN work w ON w.r = g.r AND w.c = greatest(g.c - 1, 0) JOIN work s ON s.c = g.c AND s.r = least(g.r + 1, 127) JOIN work n ON n.c = g.c AND n.r = greatest(g.r - 1, 0)) g"""
SMOOTH = """SELECT s.r, s.c, s.z, round(CASE WHEN s.z < 0 THEN greatest(s.z * (1 - f.v) + (l.v * (1 - k) + h.v * k) * f.v, s.z) ELSE s.z END, 6) AS smoothed
    FROM (SELECT *, least(greatest((-z - 5) / CAST(15 AS DOUBLE), 0), 1) AS k FROM surface) s JOIN lightly l ON l.r = s.r AND l.c = s.c JOIN heavily h ON h.r = s.r AND h.c = s.c JOIN flatness f ON f.r = s.r AND f.c = s.c"""


@query(with_views(SMOOTH, work=WORK, angle=ANGLE, **blur_sql("lightly", "work", 1.0), **blur_sql("heavily", "work", 2.0), **blur_sql("flatness", "angle", 1.0)))
def smooth_dem(spark, sf_dir):
    return focal.smooth_shoalward(surface(spark, sf_dir), 500.0, EXTENT, **SMALL, size=32).select("r", "c", "z", F.round("smoothed", 6).alias("smoothed"))


@query()
def coverage_feather(spark, sf_dir):
    """The rim of one source's cover, smoothed for cells five pixels wide."""
    own = px(spark, sf_dir).filter("src = 'N'").select("r", "c", "z")
    whole = spark.range(SIDE * SIDE).select(F.floor(F.col("id") / SIDE).cast("int").alias("r"), (F.col("id") % SIDE).cast("int").alias("c"))
    return focal.coverage_feather(whole.join(own, ["r", "c"], "left"), 5.0, EXTENT, size=64)


@query(with_views("SELECT s.r, s.c, round(sum(t.w * u.w * b.z) / sum(t.w * u.w), 6) AS mean FROM surface s, taps t, taps u, surface b WHERE b.r = s.r + t.k AND b.c = s.c + u.k GROUP BY 1, 2", taps=taps_sql(1.0)))
def gauss_valid(spark, sf_dir):
    """The mean of what is there, without an edge."""
    return focal.gaussian(surface(spark, sf_dir), 1.0, size=32).select("r", "c", F.round("mean", 6).alias("mean"))


# Components and what stands on them. The SQL finds all pairs of connected pixels, so it takes few pixels or near ones.


def _water(spark, sf_dir):
    return surface(spark, sf_dir).filter("z < -24")


SIDES = "(0, 1), (1, 0), (0, -1), (-1, 0)"
AROUND = f"{SIDES}, (1, 1), (1, -1), (-1, 1), (-1, -1)"


def reach_sql(pixels: str, steps: str, within: str = "true") -> str:
    """``sr, sc, r, c``: the pixels that each pixel reaches."""
    return f"SELECT r AS sr, c AS sc, r, c FROM {pixels} UNION SELECT a.sr, a.sc, b.r, b.c FROM reach a, (VALUES {steps}) d(dr, dc), {pixels} b WHERE b.r = a.r + dr AND b.c = a.c + dc AND {within}"


DEEP = "SELECT r, c FROM surface WHERE z < -24"
LABEL = "SELECT sr AS r, sc AS c, min(CAST(r AS BIGINT) * 4294967296 + c) AS label FROM reach GROUP BY 1, 2"


@query(with_views(LABEL, deep=DEEP, reach=reach_sql("deep", AROUND)))
def label_components(spark, sf_dir):
    return labels.label_components(_water(spark, sf_dir), diagonal=True)


@query(with_views("SELECT CAST(sum(n) AS BIGINT) AS water, count(*) AS parts, max(n) / CAST(sum(n) AS DOUBLE) AS largest_share FROM (SELECT label, count(*) AS n FROM labelled GROUP BY 1) t", deep=DEEP, reach=reach_sql("deep", SIDES), labelled=LABEL))
def water_stats(spark, sf_dir):
    sized = labels.label_components(_water(spark, sf_dir)).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return sized.agg(F.sum("n").alias("water"), F.count(F.lit(1)).alias("parts"), (F.max("n") / F.sum("n")).alias("largest_share"))


NEAR = "abs(b.r - a.sr) <= 5 AND abs(b.c - a.sc) <= 5"
SMALL_WATER = "SELECT sr, sc FROM reach JOIN surface s ON s.r = reach.r AND s.c = reach.c GROUP BY 1, 2 HAVING max(abs(reach.r - sr)) < 5 AND max(abs(reach.c - sc)) < 5 AND count(*) <= 12 AND (max(reach.r) - min(reach.r) + 1) * (max(reach.r) - min(reach.r) + 1) + (max(reach.c) - min(reach.c) + 1) * (max(reach.c) - min(reach.c) + 1) <= 36 AND min(z) >= -2"
POND_RIM = f"SELECT sr, sc, max(s.z) AS fill FROM small_water JOIN reach USING (sr, sc), (VALUES {AROUND}) d(dr, dc) LEFT JOIN surface s ON s.r = reach.r + dr AND s.c = reach.c + dc WHERE s.z IS NULL OR s.z >= 0 GROUP BY 1, 2 HAVING count(*) = count(s.z)"


@query(with_views("SELECT s.r, s.c, greatest(s.z, fill) AS z FROM surface s LEFT JOIN pond_rim p ON p.sr = s.r AND p.sc = s.c", wet="SELECT r, c FROM surface WHERE z < 0", reach=reach_sql("wet", AROUND, NEAR), small_water=SMALL_WATER, pond_rim=POND_RIM))
def pond_fill(spark, sf_dir):
    return labels.pond_fill(surface(spark, sf_dir), 12, 6).select("r", "c", "z")


@query()
def enclosed_shoals(spark, sf_dir):
    s = surface(spark, sf_dir)
    edge = (F.col("r") % 127 == 0) | (F.col("c") % 127 == 0)
    return labels.enclosed_shoals(s, [2.0, 5.0, 10.0, 20.0], edge)


@query()
def dome_candidates(spark, sf_dir):
    return labels.dome_candidates(surface(spark, sf_dir).withColumn("z", F.col("z") - 16.0), 5, 2, EXTENT, 0.0)


# Gates and the whole product.


@query(with_views(f"SELECT count(*) FILTER (zb < 0) AS compared, count(*) FILTER (zb < 0 AND za < zb - CAST(1e-9 AS DOUBLE)) AS deeper FROM (SELECT z AS zb, {quantize_sql('z', 10)} AS za FROM surface) t"))
def gate_shoal_bias(spark, sf_dir):
    s = surface(spark, sf_dir)
    return gates.shoal_bias(s, s.withColumn("z", depth.quantize(F.col("z"), 10)), ["r", "c"])


FILED = "SELECT src AS source, CAST(r % 8 AS VARCHAR) AS filename, px.z, CASE WHEN src = 'A' OR src = 'N' AND r % 8 < 4 OR px.r = px.c THEN 1 END AS ref FROM px"


@query(with_views("SELECT source, count(*) FILTER (corrected = valid) AS whole, count(*) FILTER (corrected <> valid AND corrected <> 0) AS partial, count(*) FILTER (corrected = 0) AS uncovered, sum(corrected) / CAST(sum(valid) AS DOUBLE) AS share FROM (SELECT source, filename, count(z) AS valid, count(ref) FILTER (z IS NOT NULL) AS corrected FROM filed GROUP BY 1, 2) t GROUP BY source", filed=FILED))
def coverage_report(spark, sf_dir):
    ref = F.when((F.col("src") == "A") | ((F.col("src") == "N") & (F.col("r") % 8 < 4)) | (F.col("r") == F.col("c")), 1)
    return gates.coverage_report(px(spark, sf_dir).select(F.col("src").alias("source"), (F.col("r") % 8).cast("string").alias("filename"), "z", ref.alias("ref")))


PRODUCT = f"""SELECT r >> 4 AS tile_r, c >> 4 AS tile_c, code, count(*) AS pixels, min(z) AS low, max(z) AS high FROM (
    SELECT r, c, z, CASE WHEN z > 0 AND NOT land AND z <= 16 THEN 1 WHEN z > 0 OR land THEN 2 ELSE 0 END AS code FROM (
    SELECT r, c, land, {quantize_sql('z', 10)} AS z FROM (
    SELECT r >> 1 AS r, c >> 1 AS c, coalesce(max(z) FILTER (z <= 16), max(z)) AS z, EXISTS (SELECT 1 FROM mask m WHERE m.land AND m.r >> 1 = clamped.r >> 1 AND m.c >> 1 = clamped.c >> 1) AS land FROM clamped GROUP BY 1, 2, 4) a) b) d GROUP BY 1, 2, 3"""


@query(with_views(PRODUCT, masked=MASKED, clamped="SELECT r, c, CASE WHEN land AND z < 0 THEN 0 ELSE z END AS z FROM masked"))
def classified_product(spark, sf_dir):
    """The flagship: from overlapping sources to each tile's classes."""
    return classified_tiles(px(spark, sf_dir), sources(spark), mask(spark, sf_dir), zoom=10)
