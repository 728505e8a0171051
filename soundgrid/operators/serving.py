"""Answers to tile requests, in batches: what a request is served from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundgrid.operators.covering import deepest_ancestor


def serve_raster(requests: DataFrame, planet: DataFrame, cells: DataFrame) -> DataFrame:
    """``z, x, y, answer, found_z``: the planet's tile, else the cell's, else the deepest ancestor of either (to be scaled up), else land.

    Archives have ``z, x, y``; lookups are equality joins on tiles, ancestors are exploded from the requests' side.
    """
    tag = lambda df, name: df.select("z", "x", "y", F.lit(name).alias("answer")).distinct()
    exact = tag(planet, "planet").unionByName(tag(cells, "cell")).groupBy("z", "x", "y").agg(F.max("answer").alias("exact"))
    there = planet.select("z", "x", "y").unionByName(cells.select("z", "x", "y")).distinct().withColumn("kept", F.lit(1))
    found = deepest_ancestor(requests.select("z", "x", "y").distinct(), there, ["kept"]).drop("kept")
    answered = found.join(exact, ["z", "x", "y"], "left")
    return answered.select("z", "x", "y", F.coalesce("exact", F.when(F.col("found_z").isNotNull(), F.lit("overzoom")), F.lit("land")).alias("answer"), "found_z")


def serve_vector(requests: DataFrame, leaves: DataFrame, maxzoom: int) -> DataFrame:
    """``z, x, y, status, found_z``: 200 with the baked tile or its deepest ancestor, 204 past the last zoom or where there is none."""
    found = deepest_ancestor(requests.select("z", "x", "y").distinct(), leaves.select("z", "x", "y").distinct().withColumn("kept", F.lit(1)), ["kept"]).drop("kept")
    ok = F.col("found_z").isNotNull() & (F.col("z") <= maxzoom)
    return found.select("z", "x", "y", F.when(ok, 200).otherwise(204).alias("status"), F.when(ok, F.col("found_z")).alias("found_z"))


def request_status(z: Column, x: Column, y: Column, maxzoom: int, ready: Column) -> Column:
    """400 for a tile that can't be, 503 while nothing is published, 404 past the last zoom, else 200."""
    side = F.call_function("shiftleft", F.lit(1), F.greatest(F.least(z, F.lit(30)), F.lit(0)))
    bad = (z < 0) | (z > 30) | (x < 0) | (y < 0) | (x >= side) | (y >= side)
    return F.when(bad | bad.isNull(), 400).when(~ready, 503).when(z > maxzoom, 404).otherwise(200)


def overzoom_points(points: DataFrame, dz: Column, x: Column, y: Column, extent: int = 4096, margin: int = 80) -> DataFrame:
    """A parent tile's points in a child's frame, rounded half away from zero, within the buffered box."""
    scale = F.call_function("shiftleft", F.lit(1), dz).cast("double")
    moved = lambda v, t: (lambda p: F.signum(p) * F.floor(F.abs(p) + 0.5))(F.col(v) * scale - t * float(extent))
    out = points.withColumn("px", moved("px", x)).withColumn("py", moved("py", y))
    return out.filter(F.col("px").between(-margin, extent + margin) & F.col("py").between(-margin, extent + margin))
