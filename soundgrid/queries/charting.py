"""Queries of charting rules: soundings, contours, vector features, gates over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundgrid.functions import depth
from soundgrid.operators import vectors
from soundgrid.queries import query
from soundgrid.queries.catalog import STEMS, _stems
from soundgrid.queries.views import table, with_views

D = "CAST({} AS DOUBLE)"


def _depths(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * F.lit(0.61) + F.col("l_linenumber")).alias("d"))


DEPTHS = "SELECT l_orderkey, l_linenumber, l_quantity * CAST(0.61 AS DOUBLE) + l_linenumber AS d FROM lineitem"


def _floor(x: str) -> str:
    return f"(floor({x} + CAST(1e-9 AS DOUBLE)) + CAST(0 AS DOUBLE))"


LABELS = f"CASE WHEN d < 21 THEN {_floor('d * 10')} / 10 WHEN d < 31 THEN {_floor('d * 2')} / 2 ELSE {_floor('d')} END AS depth_m, CAST({_floor('d / CAST(0.3048 AS DOUBLE)')} AS INT) AS depth_ft, CAST({_floor('d / CAST(1.8288 AS DOUBLE)')} AS INT) AS depth_fm"


@query(with_views(f"SELECT l_orderkey, l_linenumber, {LABELS} FROM depths", depths=DEPTHS))
def depth_labels(spark, sf_dir):
    m, ft, fm = depth.depth_labels(F.col("d"))
    return _depths(spark, sf_dir).select("l_orderkey", "l_linenumber", m.alias("depth_m"), ft.alias("depth_ft"), fm.alias("depth_fm"))


@query(with_views(f"SELECT l_orderkey, l_linenumber, {LABELS}, CASE WHEN l_linenumber = 1 THEN 1 END AS prime FROM depths", depths=DEPTHS))
def sounding_props(spark, sf_dir):
    m, ft, fm = depth.depth_labels(F.col("d"))
    return _depths(spark, sf_dir).select("l_orderkey", "l_linenumber", m.alias("depth_m"), ft.alias("depth_ft"), fm.alias("depth_fm"), F.when(F.col("l_linenumber") == 1, 1).alias("prime"))


@query("SELECT p_partkey, CASE WHEN p_retailprice >= 1000 THEN 2 WHEN p_retailprice >= 200 THEN 1 ELSE 0 END AS shift FROM part")
def thin_shift(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", depth.thin_shift(F.col("p_retailprice")).alias("shift"))


def _placed(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 6 + 8).cast("int").alias("minzoom"), (F.col("l_suppkey") % 3 + 11).cast("int").alias("child_z"), (F.col("l_returnflag") != "A").alias("lattice"))


PLACED = "SELECT l_orderkey, l_linenumber, CAST(l_partkey % 6 + 8 AS INT) AS minzoom, CAST(l_suppkey % 3 + 11 AS INT) AS child_z, l_returnflag <> 'A' AS lattice FROM lineitem"


@query(with_views("SELECT l_orderkey, l_linenumber, minzoom, CASE WHEN lattice AND minzoom <> child_z THEN minzoom END AS maxzoom FROM placed", placed=PLACED))
def zoom_placement(spark, sf_dir):
    return _placed(spark, sf_dir).select("l_orderkey", "l_linenumber", "minzoom", depth.zoom_placement(F.col("minzoom"), F.col("child_z"), F.col("lattice")).alias("maxzoom"))


@query(with_views("SELECT l_orderkey, l_linenumber FROM placed WHERE CASE WHEN lattice AND minzoom <> child_z THEN 11 = minzoom ELSE 11 >= minzoom END", placed=PLACED))
def displayed_at(spark, sf_dir):
    return _placed(spark, sf_dir).filter(depth.displayed_at(F.lit(11), F.col("minzoom"), F.col("child_z"), F.col("lattice"))).select("l_orderkey", "l_linenumber")


TIERS = ", ".join(f"({k}, {floor}, {level})" for k, (floor, (_, levels)) in enumerate(zip([0, *(z for z, _ in depth.CONTOUR_TIERS)], depth.CONTOUR_TIERS)) for level in levels)
LADDER = ", ".join(f"({D.format(repr(float(v)))})" for v in depth.METRE_LADDER)


LEVELLED = "SELECT p_partkey, level FROM part JOIN (VALUES {}) l(k, level) ON k = p_partkey % {}"
RUNGS, FATHOM_RUNGS = [float(v) for v in depth.METRE_LADDER], depth.ladder(True)
numbered = lambda rungs: ", ".join(f"({k}, {D.format(repr(v))})" for k, v in enumerate(rungs))


def _levelled(spark, sf_dir, rungs):
    """A level of the ladder for each part."""
    level = F.get(F.array(*(F.lit(v) for v in rungs)), (F.col("p_partkey") % len(rungs)).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", level.alias("level"))


@query(with_views(f"SELECT l.p_partkey, l.level, coalesce(min(t.floor), 11) AS minzoom FROM levelled l LEFT JOIN (VALUES {TIERS}) t(tier, floor, level) ON t.level = l.level GROUP BY 1, 2", levelled=LEVELLED.format(numbered(RUNGS), len(RUNGS))))
def ring_minzoom(spark, sf_dir):
    return _levelled(spark, sf_dir, RUNGS).withColumn("minzoom", depth.contour_minzoom(F.col("level"), F.lit(False)))


@query(with_views(f"SELECT l.p_partkey, l.level, coalesce(min(t.floor), 11) AS minzoom FROM levelled l LEFT JOIN (SELECT tier, floor, min(level) AS least FROM (VALUES {TIERS}) t(tier, floor, level) GROUP BY 1, 2) t ON l.level >= t.least GROUP BY 1, 2", levelled=LEVELLED.format(numbered(FATHOM_RUNGS), len(FATHOM_RUNGS))))
def contour_minzoom(spark, sf_dir):
    return _levelled(spark, sf_dir, FATHOM_RUNGS).withColumn("minzoom", depth.contour_minzoom(F.col("level"), F.lit(True)))


@query(f"SELECT p_partkey, CASE WHEN p_size = 0 THEN 0 ELSE coalesce((SELECT min(level) FROM (VALUES {LADDER}) l(level) WHERE level >= p_size - CAST(0.01 AS DOUBLE)), 10000) END AS level FROM part")
def snap_safety(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", depth.snap_safety(F.col("p_size").cast("double"), depth.ladder()).alias("level"))


@query("SELECT c_custkey, coalesce(kind, '') NOT IN ('lake', 'reservoir') OR coalesce(class = 'lagoon', false) OR coalesce(salt, false) OR coalesce(tidal = 'yes', false) AND coalesce(salt, true) AS dries FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'lake' WHEN 1 THEN 'reservoir' WHEN 2 THEN 'river' END AS kind, CASE WHEN c_custkey % 5 = 0 THEN 'lagoon' END AS class, CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS salt, CASE WHEN c_custkey % 7 < 3 THEN 'yes' END AS tidal FROM customer) t")
def may_dry(spark, sf_dir):
    k = F.col("c_custkey")
    kind = F.when(k % 4 == 0, "lake").when(k % 4 == 1, "reservoir").when(k % 4 == 2, "river")
    salt = F.when(k % 3 == 0, True).when(k % 3 == 1, False)
    return table(spark, sf_dir, "customer").select(k, depth.may_dry(kind, F.when(k % 5 == 0, "lagoon"), salt, F.when(k % 7 < 3, "yes")).alias("dries"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND (o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_totalprice >= 100000)")
def water_filter(spark, sf_dir):
    """Kinds that are left out, and an area that all but channels must have."""
    return table(spark, sf_dir, "orders").filter((F.col("o_orderstatus") != "P") & (F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") | (F.col("o_totalprice") >= 100000))).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus NOT IN ('P') AND o_custkey BETWEEN 100 AND 400")
def water_window_read(spark, sf_dir):
    """A window of a table: both conditions reach the scan."""
    return table(spark, sf_dir, "orders").filter("o_orderstatus not in ('P') and o_custkey between 100 and 400").select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE CASE l_returnflag WHEN 'A' THEN true WHEN 'N' THEN l_quantity >= 10 ELSE sqrt(l_extendedprice) >= 150 END")
def survives_leaf(spark, sf_dir):
    """Points always, lines by length, areas by the root of theirs."""
    keep = F.when(F.col("l_returnflag") == "A", True).when(F.col("l_returnflag") == "N", F.col("l_quantity") >= 10).otherwise(F.sqrt("l_extendedprice") >= 150)
    return table(spark, sf_dir, "lineitem").filter(keep).select("l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber, l_quantity AS drval1 FROM lineitem WHERE l_returnflag = 'A' AND CASE WHEN l_linestatus = 'F' THEN l_quantity END >= 0")
def mbands(spark, sf_dir):
    drval1 = F.when(F.col("l_linestatus") == "F", F.col("l_quantity"))
    return table(spark, sf_dir, "lineitem").filter((F.col("l_returnflag") == "A") & drval1.isNotNull() & (drval1 >= 0)).select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("drval1"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE 20 - l_quantity > 0 AND 20 - l_quantity <= 16 AND l_returnflag <> 'N'")
def drying_bucket(spark, sf_dir):
    z = F.lit(20.0) - F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").filter((z > 0) & (z <= depth.DRYING_CAP) & (F.col("l_returnflag") != "N")).select("l_orderkey", "l_linenumber")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN '{\"a\":' || CAST(s_suppkey AS VARCHAR) || '}' ELSE '{\"a\":' || CAST(s_suppkey AS VARCHAR) || ',\"b\":1}' END AS props FROM supplier")
def json_scalar(spark, sf_dir):
    """Missing values are missing from the document."""
    row = F.struct(F.col("s_suppkey").alias("a"), F.when(F.col("s_suppkey") % 2 == 1, 1).alias("b"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.to_json(row).alias("props"))


@query("SELECT user_id, event_type, CAST(json_extract_string(props, '$.page') AS VARCHAR) AS page, count(*) AS n FROM events GROUP BY 1, 2, 3")
def json_field(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type", F.get_json_object("props", "$.page").alias("page")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, round(0.01 * CAST(40075016.685578488 AS DOUBLE) / 360 * cos(radians(c_custkey % 85)), 6) AS metres FROM customer")
def pixel_metres(spark, sf_dir):
    from soundgrid.functions.tiles import pixel_metres as metres

    return table(spark, sf_dir, "customer").select("c_custkey", F.round(metres(F.lit(0.01), (F.col("c_custkey") % 85).cast("double")), 6).alias("metres"))


# Features: an octagon or a box for each part, on a grid so that boxes share edges.


def _boxes(spark, sf_dir):
    k = F.col("p_partkey")
    i, j = k % 40, F.floor(k / 40)
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    ring = F.array(point(i, j), point(i + 1, j), point(i + 1, j + 1), point(i, j + 1))
    return table(spark, sf_dir, "part").filter("p_partkey % 7 <> 3").select(k.alias("id"), "p_size", ring.alias("ring"))


BOXES = "SELECT p_partkey AS id, p_size, p_partkey % 40 AS i, p_partkey // 40 AS j FROM part WHERE p_partkey % 7 <> 3"


@query(with_views("SELECT p_size, count(*) AS parts, CAST(count(*) * 4 AS BIGINT) AS vertices, CAST(0 AS DOUBLE) AS small_share FROM boxes GROUP BY 1", boxes=BOXES))
def vector_metrics(spark, sf_dir):
    return vectors.vector_metrics(_boxes(spark, sf_dir), ["p_size"], 0.5)


@query(with_views("SELECT i + 1 AS ax, j AS ay, i + 1 AS bx, j + 1 AS by, id AS low, other AS high FROM (SELECT a.*, b.id AS other FROM boxes a JOIN boxes b ON b.i = a.i + 1 AND b.j = a.j) t UNION ALL SELECT i, j + 1, i + 1, j + 1, id, other FROM (SELECT a.*, b.id AS other FROM boxes a JOIN boxes b ON b.i = a.i AND b.j = a.j + 1) t", boxes=BOXES))
def shared_edge_join(spark, sf_dir):
    return vectors.shared_edges(_boxes(spark, sf_dir))


def _scaled(spark, sf_dir, w, h):
    """Boxes from their lower left corners on, as wide and high as told."""
    b = _boxes(spark, sf_dir)
    x, y = F.col("ring")[0]["x"], F.col("ring")[0]["y"]
    at = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    zero = F.lit(0.0)
    return b.withColumn("ring", F.array(at(zero, zero), at(w, zero), at(w, h), at(zero, h)))


@query(with_views("SELECT id FROM boxes WHERE p_size * 40 < 1000 OR (p_size % 7 + 1) * 1000 * (id % 5 + 1) * 1500 >= 16000000", boxes=BOXES))
def deep_ring_drop(spark, sf_dir):
    """Rings of one to 52 square kilometres."""
    rings = _scaled(spark, sf_dir, (F.col("p_size") % 7 + 1) * 1000.0, (F.col("id") % 5 + 1) * 1500.0)
    return vectors.deep_ring_drop(rings.withColumn("level", F.col("p_size") * 40.0)).select("id")


SIZED = "SELECT id, p_size % 2 = 0 AS drying, (p_size % 5 + 1) * CAST(0.5 AS DOUBLE) AS w, (id % 7 + 1) * CAST(0.25 AS DOUBLE) AS h FROM boxes"


@query(with_views("SELECT id, drying FROM sized WHERE CASE WHEN drying THEN NOT (w * h < 2 AND w * h * 2 / (2 * (w + h)) < 0.4) ELSE w * h >= 2 END", boxes=BOXES, sized=SIZED))
def legibility_gates(spark, sf_dir):
    b = _scaled(spark, sf_dir, (F.col("p_size") % 5 + 1) * 0.5, (F.col("id") % 7 + 1) * 0.25).withColumn("drying", F.col("p_size") % 2 == 0)
    return b.filter(vectors.legible(vectors.ring_area(F.col("ring")), vectors.ring_length(F.col("ring")), 2.0, 0.4, F.col("drying"))).select("id", "drying")


@query(with_views("SELECT id, CAST(j * 4 + a AS INT) AS r, CAST(i * 4 + b AS INT) AS c FROM boxes, range(4) x(a), range(4) y(b) WHERE j * 4 + a < 1024", boxes=BOXES))
def rasterize_mask(spark, sf_dir):
    scaled = _boxes(spark, sf_dir).withColumn("ring", F.transform("ring", lambda p: F.struct((p["x"] * 4.0).alias("x"), (p["y"] * 4.0).alias("y"))))
    return vectors.rasterize(scaled, 1024)


FINE = "SELECT stem, CAST(x AS BIGINT) << (20 - z) AS l, CAST(x + 1 AS BIGINT) << (20 - z) AS r, CAST(y AS BIGINT) << (20 - z) AS t, CAST(y + 1 AS BIGINT) << (20 - z) AS b FROM stems WHERE child_z = 10"


@query(with_views("SELECT a.stem, o.stem AS other, 'east' AS side FROM fine a JOIN fine o ON a.r % 1048576 = o.l AND a.t < o.b AND o.t < a.b UNION ALL SELECT a.stem, o.stem, 'south' FROM fine a JOIN fine o ON a.b = o.t AND a.l < o.r AND o.l < a.r", stems=STEMS, fine=FINE))
def adjacency(spark, sf_dir):
    return vectors.seam_adjacency(_stems(spark, sf_dir).filter("child_z = 10"))
