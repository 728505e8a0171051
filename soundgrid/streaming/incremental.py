"""Changes of a surface as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(changes: DataFrame, keys: list[str], at: str, values: list[str]) -> DataFrame:
    """The latest values of each key. Over a stream this is a running aggregate (update mode), over a table a plain one."""
    best = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(at)).alias("b"))
    return best.select(*keys, *(F.col(f"b.{v}").alias(v) for v in values))


def windowed_counts(events: DataFrame, at: str, key: str, late: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """Events by tumbling window and key; windows close once the watermark has passed them."""
    stamped = events.withColumn("_at", F.col(at).cast("timestamp"))
    if stamped.isStreaming:
        stamped = stamped.withWatermark("_at", late)
    counted = stamped.groupBy(F.window("_at", width).alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("w.start").alias("start"), key, "n", "total")


def rebuild_changed(changes: DataFrame, keys: list[str], rebuild, checkpoint: str):
    """Run ``rebuild(keys of a batch, batch number)`` once for each micro-batch with the tiles that it touched, until the source is read up."""

    def batch(df: DataFrame, n: int) -> None:
        rebuild(df.select(*keys).distinct(), n)

    return changes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
