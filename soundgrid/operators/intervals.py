"""One-dimensional intervals: ``keys, lo, hi``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def interval_union(df: DataFrame, keys: list[str]) -> DataFrame:
    """The fewest disjoint intervals that cover the same: an interval starts a new island where it begins after all before it have ended."""
    w = Window.partitionBy(*keys).orderBy("lo", "hi")
    reach = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = (reach.isNull() | (F.col("lo") > reach)).cast("int")
    marked = df.withColumn("_new", new).withColumn("_island", F.sum("_new").over(w))
    return marked.groupBy(*keys, "_island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_island")


def coverage(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Stretches between neighbouring ends with how many intervals of either side cover them: the sweep that the operators below read."""
    ends = None
    for df, one, two in ((a, 1, 0), (b, 0, 1)):
        e = df.select(*keys, F.explode(F.array(F.struct(F.col("lo").alias("p"), F.lit(one).alias("da"), F.lit(two).alias("db")), F.struct(F.col("hi").alias("p"), F.lit(-one).alias("da"), F.lit(-two).alias("db")))).alias("e")).select(*keys, "e.*")
        ends = e if ends is None else ends.unionByName(e)
    steps = ends.groupBy(*keys, "p").agg(F.sum("da").alias("da"), F.sum("db").alias("db"))
    w = Window.partitionBy(*keys).orderBy("p")
    return steps.select(*keys, F.col("p").alias("lo"), F.lead("p").over(w).alias("hi"), F.sum("da").over(w).alias("in_a"), F.sum("db").over(w).alias("in_b")).filter("hi is not null")


def interval_intersect(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return interval_union(coverage(a, b, keys).filter("in_a > 0 and in_b > 0").select(*keys, "lo", "hi"), keys)


def interval_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """What only one of both covers."""
    return interval_union(coverage(a, b, keys).filter("(in_a > 0) <> (in_b > 0)").select(*keys, "lo", "hi"), keys)
