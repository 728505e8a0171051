"""Queries over requests: routing, colours, tags, samples of positions; and over streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundgrid.functions import depth, tiles
from soundgrid.queries import query
from soundgrid.queries.views import surface, table, with_views
from soundgrid.sinks import tables
from soundgrid.streaming import incremental

HW = tiles.HALF_WORLD


def _positions(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") * 37 % 3600 / 10.0 - 180.0).alias("lon"), (F.col("c_custkey") * 53 % 1600 / 10.0 - 80.0).alias("lat"))


POSITIONS = "SELECT c_custkey, c_custkey * 37 % 3600 / CAST(10 AS DOUBLE) - 180 AS lon, c_custkey * 53 % 1600 / CAST(10 AS DOUBLE) - 80 AS lat FROM customer"


@query(with_views("SELECT c_custkey, CAST(floor(x) AS INT) AS tx, CAST(floor(y) AS INT) AS ty, CAST(floor((x - floor(x)) * 512) AS INT) AS px, CAST(floor((y - floor(y)) * 512) AS INT) AS py FROM (SELECT c_custkey, (lon + 180) / 360 * 1024 AS x, (1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 1024 AS y FROM positions) t", positions=POSITIONS))
def lonlat_tile(spark, sf_dir):
    tx, ty, px, py = tiles.lonlat_tile(F.col("lon"), F.col("lat"), 10)
    return _positions(spark, sf_dir).select("c_custkey", tx.alias("tx"), ty.alias("ty"), px.alias("px"), py.alias("py"))


@query(with_views("SELECT p.c_custkey, s.z FROM (SELECT c_custkey, CAST(c_custkey * 31 % 128 AS INT) AS r, CAST(c_custkey * 17 % 128 AS INT) AS c FROM customer) p LEFT JOIN surface s ON s.r = p.r AND s.c = p.c"))
def read_depth(spark, sf_dir):
    asked = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") * 31 % 128).cast("int").alias("r"), (F.col("c_custkey") * 17 % 128).cast("int").alias("c"))
    return asked.join(surface(spark, sf_dir), ["r", "c"], "left").select("c_custkey", "z")


@query(with_views("SELECT c_custkey, lon BETWEEN -75 AND 30 AND lat BETWEEN -20 AND 65 AS inside FROM positions", positions=POSITIONS))
def in_mask_bounds(spark, sf_dir):
    return _positions(spark, sf_dir).select("c_custkey", (F.col("lon").between(-75.0, 30.0) & F.col("lat").between(-20.0, 65.0)).alias("inside"))


@query("SELECT page_id, 'v1-' || substr(sha256(url), 1, 16) AS etag FROM pages")
def content_etag(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("v1-"), F.substring(F.sha2("url", 256), 1, 16)).alias("etag"))


@query("SELECT p_partkey, regexp_extract(path, '^/preview/(\\d+)/(\\d+)/(\\d+)\\.png$', 1) AS z, regexp_extract(path, '^/preview/(\\d+)/(\\d+)/(\\d+)\\.png$', 2) AS x FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '/other' ELSE '/preview/' || CAST(p_size AS VARCHAR) || '/' || CAST(p_partkey AS VARCHAR) || '/7.png' END AS path FROM part) t")
def preview_route(spark, sf_dir):
    path = F.when(F.col("p_partkey") % 3 == 0, "/other").otherwise(F.concat_ws("/", F.lit("/preview"), F.col("p_size").cast("string"), F.col("p_partkey").cast("string"), F.lit("7.png")))
    part = lambda k: F.regexp_extract(path, r"^/preview/(\d+)/(\d+)/(\d+)\.png$", k)
    return table(spark, sf_dir, "part").select("p_partkey", part(1).alias("z"), part(2).alias("x"))


@query("SELECT n_nationkey, coalesce(CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey + 8 END, n_regionkey + 5) AS maxzoom FROM nation")
def serve_max_zoom(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.select("n_nationkey", F.coalesce(F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey") + 8), F.col("n_regionkey") + 5).alias("maxzoom"))


STOPS = [(0.0, 0.0), (5.0, 0.25), (20.0, 0.5), (200.0, 1.0)]


@query("SELECT l_orderkey, l_linenumber, round(CASE WHEN d < 0 THEN 0 WHEN d < 5 THEN d / 5 * CAST(0.25 AS DOUBLE) WHEN d < 20 THEN CAST(0.25 AS DOUBLE) + (d - 5) / 15 * CAST(0.25 AS DOUBLE) WHEN d < 200 THEN CAST(0.5 AS DOUBLE) + (d - 20) / 180 * CAST(0.5 AS DOUBLE) ELSE 1 END, 9) AS shade, CASE WHEN d >= 30 THEN 'deep' WHEN d >= 10 THEN 'middle' WHEN d >= 0 THEN 'shallow' ELSE 'drying' END AS colour FROM (SELECT l_orderkey, l_linenumber, l_quantity - 5 AS d FROM lineitem) t")
def depth_ramp(spark, sf_dir):
    d = F.col("l_quantity") - 5
    colour = F.when(d >= 30, "deep").when(d >= 10, "middle").when(d >= 0, "shallow").otherwise("drying")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(depth.ramp(d, STOPS), 9).alias("shade"), colour.alias("colour"))


@query("SELECT 'planet' AS archive, min(l_linenumber) AS minzoom, max(l_linenumber) AS maxzoom, min(l_partkey) AS \"left\", max(l_partkey) AS \"right\", min(l_suppkey) AS top, max(l_suppkey) AS bottom, count(*) AS tiles FROM lineitem")
def stage_build(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("z"), F.col("l_partkey").alias("x"), F.col("l_suppkey").alias("y"))
    return tables.archive_header(rows).select(F.lit("planet").alias("archive"), "*")


HILBERT = """WITH RECURSIVE walk(key, s, x, y, d) AS (
    SELECT key, 16, x, y, CAST(0 AS BIGINT) FROM (SELECT DISTINCT l_partkey % 32 * 32 + l_suppkey % 32 AS key, l_partkey % 32 AS x, l_suppkey % 32 AS y FROM lineitem) t
    UNION ALL SELECT key, s // 2, CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN s - 1 - y ELSE y END ELSE x END, CASE WHEN ry = 0 THEN CASE WHEN rx = 1 THEN s - 1 - x ELSE x END ELSE y END, d + s * s * xor(3 * rx, ry)
    FROM (SELECT *, CASE WHEN x & s > 0 THEN 1 ELSE 0 END AS rx, CASE WHEN y & s > 0 THEN 1 ELSE 0 END AS ry FROM walk WHERE s >= 1) w)
    SELECT key // 32 AS x, key % 32 AS y, 341 + d AS tile_id FROM walk WHERE s = 0"""


@query(HILBERT)
def tile_id_order(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 32).alias("x"), (F.col("l_suppkey") % 32).alias("y")).distinct()
    return tables.archive(rows, 5)


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2")
def stream_windows(spark, sf_dir):
    """The batch form of the windowed stream."""
    out = incremental.windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 6).alias("total"))


@query("SELECT user_id, event_type, value FROM (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) t WHERE k = 1")
def stream_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id"))
    return incremental.latest_by_key(events, ["user_id"], "at", ["event_type", "value"])
