"""The domain's tables as views of the star schema: overlapping pixels, sources, masks, files, points, registrations.

Each is given as a DataFrame and as a named SQL view; ``with_views`` puts the views that a statement needs before it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soundgrid.functions.tiles import HALF_WORLD
from soundgrid.operators.merge import priority_fill

SIDE = 128


#: Top, left, bottom and right of the grid.
EXTENT = (0, 0, SIDE - 1, SIDE - 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def px(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping pixels of three sources on a grid of 128 by 128."""
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % SIDE).cast("int").alias("r"), (F.col("l_partkey") % SIDE).cast("int").alias("c"), F.col("l_returnflag").alias("src"), (F.lit(20.0) - F.col("l_quantity") - F.col("l_linenumber") / F.lit(4.0)).alias("z"))
    return rows.groupBy("r", "c", "src").agg(F.max("z").alias("z"))


def sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("A", 0, 8), ("N", 0, 11), ("R", 1, 9)], "src string, priority int, maxzoom int")


def surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    return priority_fill(px(spark, sf_dir), sources(spark), ["r", "c"]).select("r", "c", "z")


def mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy((F.col("o_orderkey") % SIDE).cast("int").alias("r"), (F.col("o_custkey") % SIDE).cast("int").alias("c"))
    return orders.agg((F.max("o_totalprice") > 300000).alias("land"), (F.min("o_orderpriority") == "1-URGENT").alias("tidal"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each customer with orders; one in eleven crosses the antimeridian."""
    keys = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).distinct()
    left = (F.col("k") * 7919 % 1000) / 1000.0 * (1.9 * HALF_WORLD) - HALF_WORLD
    bottom = (F.col("k") * 6007 % 1000) / 1000.0 * (1.9 * HALF_WORLD) - HALF_WORLD
    size = (F.col("k") % 13 + 1) * 60000.0
    placed = keys.select("k", left.alias("l"), bottom.alias("bottom"), size.alias("size"))
    wraps = F.col("k") % 11 == 0
    edge = F.lit(HALF_WORLD)
    return placed.select(
        F.concat(F.lit("s"), (F.col("k") % 7).cast("string")).alias("source"),
        F.concat(F.lit("f"), F.col("k").cast("string")).alias("filename"),
        F.when(wraps, edge - F.col("size")).otherwise(F.col("l")).alias("left"),
        F.col("bottom"),
        F.when(wraps, F.col("size") - edge).otherwise(F.col("l") + F.col("size")).alias("right"),
        (F.col("bottom") + F.col("size")).alias("top"),
        (F.col("k") % 5000 + 100).cast("int").alias("width"),
        (F.col("k") % 3000 + 100).cast("int").alias("height"),
        (F.col("k") % 8 + 6).cast("int").alias("maxzoom"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    return rows.select(F.col("c_custkey").alias("id"), ((F.col("c_custkey") * 6151 % 12700) / 100.0).alias("x"), ((F.col("c_custkey") * 3571 % 12700) / 100.0).alias("y"))


def registrations(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """A listing of one order status: a key for each customer, with a value that may be missing."""
    rows = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == status)
    return rows.groupBy(F.concat(F.lit("f"), F.col("o_custkey").cast("string")).alias("filename")).agg(F.max(F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey"))).alias("value"))


VIEWS = {
    "px": "SELECT CAST(l_orderkey % 128 AS INT) AS r, CAST(l_partkey % 128 AS INT) AS c, l_returnflag AS src, max(CAST(20 AS DOUBLE) - l_quantity - l_linenumber / CAST(4 AS DOUBLE)) AS z FROM lineitem GROUP BY 1, 2, 3",
    "srcs": "SELECT * FROM (VALUES ('A', 0, 8), ('N', 0, 11), ('R', 1, 9)) t(src, priority, maxzoom)",
    "surface": "SELECT r, c, z FROM (SELECT r, c, z, row_number() OVER (PARTITION BY r, c ORDER BY priority DESC, maxzoom DESC, px.src) AS k FROM px JOIN srcs ON px.src = srcs.src) t WHERE k = 1",
    "mask": "SELECT CAST(o_orderkey % 128 AS INT) AS r, CAST(o_custkey % 128 AS INT) AS c, max(o_totalprice) > 300000 AS land, min(o_orderpriority) = '1-URGENT' AS tidal FROM orders GROUP BY 1, 2",
    "files": f"""SELECT 's' || CAST(k % 7 AS VARCHAR) AS source, 'f' || CAST(k AS VARCHAR) AS filename,
        CASE WHEN k % 11 = 0 THEN CAST({HALF_WORLD!r} AS DOUBLE) - size ELSE l END AS "left", bottom,
        CASE WHEN k % 11 = 0 THEN size - CAST({HALF_WORLD!r} AS DOUBLE) ELSE l + size END AS "right", bottom + size AS top,
        CAST(k % 5000 + 100 AS INT) AS width, CAST(k % 3000 + 100 AS INT) AS height, CAST(k % 8 + 6 AS INT) AS maxzoom
        FROM (SELECT k, (k * 7919 % 1000) / CAST(1000 AS DOUBLE) * CAST({1.9 * HALF_WORLD!r} AS DOUBLE) - CAST({HALF_WORLD!r} AS DOUBLE) AS l, (k * 6007 % 1000) / CAST(1000 AS DOUBLE) * CAST({1.9 * HALF_WORLD!r} AS DOUBLE) - CAST({HALF_WORLD!r} AS DOUBLE) AS bottom, (k % 13 + 1) * CAST(60000 AS DOUBLE) AS size
        FROM (SELECT DISTINCT o_custkey AS k FROM orders) q) t""",
    "points": "SELECT c_custkey AS id, (c_custkey * 6151 % 12700) / CAST(100 AS DOUBLE) AS x, (c_custkey * 3571 % 12700) / CAST(100 AS DOUBLE) AS y FROM customer",
    "regs_before": "SELECT 'f' || CAST(o_custkey AS VARCHAR) AS filename, max(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END) AS value FROM orders WHERE o_orderstatus = 'F' GROUP BY 1",
    "regs_now": "SELECT 'f' || CAST(o_custkey AS VARCHAR) AS filename, max(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END) AS value FROM orders WHERE o_orderstatus = 'O' GROUP BY 1",
}


def with_views(body: str, **more: str) -> str:
    """The statement with the views that it names (and those that these name) as common table expressions before it."""
    known = VIEWS | more
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(re.sub(rf"\b{name}\b", "", known[name]))
                if name not in needed:
                    needed.append(name)

    visit(body)
    return ("WITH RECURSIVE " + ", ".join(f"{n} AS ({known[n]})" for n in needed) + " " if needed else "") + body
