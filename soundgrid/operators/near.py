"""Nearest neighbours of points, by cells that shrink where points are dense."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundgrid.shipping import discard, written

_AROUND = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]


def _cell(reach: float, level: Column | int) -> list[Column]:
    """Row and column of the cells of a level: as wide as the reach at level 0, half as wide at each next one."""
    level = F.lit(level) if isinstance(level, int) else level
    side = F.lit(float(reach)) / F.pow(F.lit(2.0), level.cast("double"))
    return [F.floor(F.col("x") / side).alias("cx"), F.floor(F.col("y") / side).alias("cy")]


def leaf_levels(points: DataFrame, reach: float, most: int, deepest: int) -> DataFrame:
    """``points(x, y, ...)`` with ``level``: the first at which a point's cell holds ``most`` of them at most, or else ``deepest``. Cells are halved only where they hold more."""
    left, done = points, []
    for level in range(deepest + 1):
        celled = left.select("*", *_cell(reach, level))
        sizes = written(celled.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most), "cells")
        if level == deepest or not sizes.limit(1).count():
            done.append(left.withColumn("level", F.lit(level)))
            break
        # The crowded cells' points go on; a cell's points meet it by equality, and there are at most n / most such cells.
        told = written(celled.join(sizes, ["cx", "cy"], "left"), "told")
        done.append(told.filter("_n is null").drop("cx", "cy", "_n").withColumn("level", F.lit(level)))
        left = told.filter("_n is not null").drop("cx", "cy", "_n")
    return reduce(DataFrame.unionByName, done)


def nearest_neighbour(points: DataFrame, others: DataFrame, reach: float, most: int = 64, deepest: int = 24) -> DataFrame:
    """The nearest of ``others(id, x, y)`` to each of ``points(id, x, y)`` within ``reach``, not itself; ties to the smaller id.

    ``id, near_id, distance``; points without one have no row, and neither do nulls. Places of ``others`` are joined as one each with their two least ids, so that
    repeated places are one. Points at a place with another id have that one. Any other asks first in a cell that holds ``most`` places at most, or one as wide as the reach, and in the eight around. What it finds as near as the
    cell is wide is the nearest; else it asks again in cells twice as wide, up to the reach. Points that ask again are farther from each other than the last cells were wide, so each cell
    has a few of them, however uneven the points are: no task meets a crowd with a crowd. (Points where no place is begin at the widest cells.)
    """
    known = others.filter("x is not null and y is not null").select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    there = written(known.groupBy("x", "y").agg(F.min("id").alias("first"), F.max("id").alias("last")), "places")
    # The second least id, where several stand at one place.
    shared = there.filter("first < last").select("x", "y", F.col("first").alias("_first"))
    second = known.join(shared, ["x", "y"]).filter(F.col("id") != F.col("_first")).groupBy("x", "y").agg(F.min("id").alias("second"))
    places = there.drop("last").join(second, ["x", "y"], "left")
    asking = points.filter("x is not null and y is not null").select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    # What stands at a point's own place is nearest, so only points that are alone there go on to ask around, however many share a place.
    other = F.when(F.col("_p.first") != F.col("id"), F.col("_p.first")).otherwise(F.col("_p.second"))
    stood = asking.join(places.select(F.col("x").alias("_x"), F.col("y").alias("_y"), F.struct("first", "second").alias("_p")), (F.col("x") == F.col("_x")) & (F.col("y") == F.col("_y")), "left")
    told = written(stood.select("id", "x", "y", other.alias("near_id"), F.sqrt((F.col("x") - F.col("_x")) ** 2 + (F.col("y") - F.col("_y")) ** 2).alias("distance")), "told")
    here = told.filter("near_id is not null and distance = 0").select("id", "near_id", "distance")
    asking = told.filter("not coalesce(near_id is not null and distance = 0, false)").select("id", "x", "y")
    # A point's level is that of the places' cell in which it lies; where there is none it begins at the widest.
    levels = written(leaf_levels(places, reach, most, deepest), "levels")
    used = [r[0] for r in levels.groupBy("level").count().orderBy("level").collect()]
    if not used:
        return asking.select("id", F.lit(None).cast("long").alias("near_id"), F.lit(None).cast("double").alias("distance")).limit(0)
    top = used[-1]
    leaf = reduce(DataFrame.unionByName, (levels.filter(F.col("level") == k).select(*_cell(reach, k)).distinct().withColumn("level", F.lit(k)) for k in used))
    at = asking.withColumn("level", F.explode(F.array(*(F.lit(k) for k in used)))).select("id", "x", "y", "level", *_cell(reach, F.col("level")))
    first = at.join(leaf, ["level", "cx", "cy"]).groupBy("id", "x", "y").agg(F.max("level").alias("level"))
    asked = written(asking.join(first.select(F.col("id").alias("_id"), F.col("x").alias("_x"), F.col("y").alias("_y"), "level"), (F.col("id") == F.col("_id")) & (F.col("x") == F.col("_x")) & (F.col("y") == F.col("_y")), "left").select("id", "x", "y", F.coalesce("level", F.lit(0)).alias("level")), "asking")
    found = [here]
    for level in range(top, -1, -1):
        own = asked.filter(F.col("level") == level)
        step = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in _AROUND)))
        spread = own.select("id", "x", "y", *_cell(reach, level)).withColumn("d", step).select("id", "x", "y", (F.col("cx") + F.col("d.i")).alias("cx"), (F.col("cy") + F.col("d.j")).alias("cy"))
        near = levels.select(F.col("x").alias("nx"), F.col("y").alias("ny"), "first", "second", *_cell(reach, level))
        met = spread.join(near, ["cx", "cy"]).withColumn("near_id", F.when(F.col("first") != F.col("id"), F.col("first")).otherwise(F.col("second"))).filter("near_id is not null")
        distance = F.sqrt((F.col("x") - F.col("nx")) ** 2 + (F.col("y") - F.col("ny")) ** 2)
        best = met.groupBy("id", "x", "y").agg(F.min(F.struct(distance.alias("distance"), "near_id")).alias("b"))
        side = reach / 2.0**level
        sure = written(best.filter(F.col("b.distance") <= side), "found")
        found.append(sure.select("id", "b.near_id", "b.distance"))
        if level == 0:
            break
        rest = own.join(sure.select("id", "x", "y"), ["id", "x", "y"], "left_anti").withColumn("level", F.lit(level - 1))
        before, asked = asked, written(asked.filter(F.col("level") < level).unionByName(rest), "asking")
        discard(before)
    return reduce(DataFrame.unionByName, found)
