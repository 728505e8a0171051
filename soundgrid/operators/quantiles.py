"""Exact quantiles of any number of rows, without all of a group's values in one buffer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from soundgrid.shipping import written


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """``keys`` and a column for each of ``probabilities``: the value at that share of the sorted rows, between two of them by linear interpolation.

    Equal values are counted first, so a value that holds much of a group is one row. What is left is dealt into ranges of key and value; ranges are counted, and only the one
    that holds a rank is put in order. Null values don't count, and groups without any have no row; null keys are a group.
    """
    names = list(probabilities)
    key = F.struct(*keys).alias("_k") if keys else F.struct(F.lit(0).alias("all")).alias("_k")
    counted = rows.filter(F.col(value).isNotNull()).groupBy(key, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    ranged = written(counted.repartitionByRange("_k", "_v").withColumn("_part", F.spark_partition_id()), "ranges")
    within = Window.partitionBy("_k")
    sizes = ranged.groupBy("_k", "_part").agg(F.sum("_n").alias("_size"))
    sizes = sizes.withColumns({"_end": F.sum("_size").over(within.orderBy("_part")), "_total": F.sum("_size").over(within)}).withColumn("_before", F.col("_end") - F.col("_size"))

    def rank(p: float, up: bool):
        at = F.lit(p) * (F.col("_total") - 1)
        low = F.floor(at)
        return F.struct((F.least(low + 1, F.col("_total") - 1) if up else low).alias("rank"), (at - low).alias("share"))

    asked = [F.struct(F.lit(i).alias("i"), F.lit(up).alias("up"), rank(probabilities[n], up).alias("at")) for i, n in enumerate(names) for up in (False, True)]
    wanted = sizes.withColumn("_ask", F.explode(F.array(*asked))).filter((F.col("_ask.at.rank") >= F.col("_before")) & (F.col("_ask.at.rank") < F.col("_end")))
    asks = wanted.groupBy("_k", "_part").agg(F.first("_before").alias("_before"), F.collect_list("_ask").alias("_asks"))
    # Only the ranges that hold a rank, in order.
    inner = Window.partitionBy("_k", "_part").orderBy("_v")
    placed = ranged.join(asks, ["_k", "_part"]).withColumn("_to", F.col("_before") + F.sum("_n").over(inner)).withColumn("_from", F.col("_to") - F.col("_n"))
    hits = placed.select("_k", "_v", "_from", "_to", F.explode("_asks").alias("_ask")).filter((F.col("_ask.at.rank") >= F.col("_from")) & (F.col("_ask.at.rank") < F.col("_to")))
    pick = lambda i, up: F.max(F.when((F.col("_ask.i") == i) & (F.col("_ask.up") == up), F.col("_v")))
    share = lambda i: F.max(F.when(F.col("_ask.i") == i, F.col("_ask.at.share")))
    found = hits.groupBy("_k").agg(*(((pick(i, True) - pick(i, False)) * share(i) + pick(i, False)).alias(n) for i, n in enumerate(names)))
    return found.select(*(F.col("_k").getField(k).alias(k) for k in keys), *names)
