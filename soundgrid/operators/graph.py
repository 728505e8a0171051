"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundgrid.operators.skew import join_by_key
from soundgrid.shipping import discard, written

#: With fewer edges than this, even one node with all of them is a small task's work.
FEW = 1 << 20


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, label`` of each node of ``edges(a, b)``: the label is its component's smallest node.

    Each round ties every node's larger neighbours, and then its smaller ones, to the smallest of them: groupings and joins on
    nodes (rows of a node with many neighbours aren't dealt by it). The number of rounds grows as the logarithm of the nodes; the driver sees a count and a sum of hashes of each.
    """
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "graph")
    sign = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    seen = sign(edges)
    for _ in range(rounds):
        if not seen[0]:
            break
        total = seen[0]
        met = lambda rows, facts, key: join_by_key(rows, facts, key, 2 * total) if total > FEW else rows.join(facts, key)
        pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("u", "m"))
        large = met(pairs.filter("v > u"), least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        both = F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        before, edges = edges, written(met(large, least, "a").select(both.alias("e")).select("e.*").filter("a <> b").distinct(), "graph")
        discard(before)
        now = sign(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components not settled in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
