"""From overlapping sources to classified tiles: the library's smallest whole product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundgrid.functions.depth import classify_pixel, land_clamp, quantize
from soundgrid.operators.merge import priority_fill, shoal_reduce


def classified_tiles(pixels: DataFrame, sources: DataFrame, mask: DataFrame, zoom: int, levels: int = 1, tile_shift: int = 4) -> DataFrame:
    """Layer sources, clamp land, halve, quantize, classify, and count each tile's classes: ``tile_r, tile_c, code, pixels, low, high``."""
    surface = priority_fill(pixels, sources, ["r", "c"])
    masked = surface.join(mask, ["r", "c"], "left").withColumn("land", F.coalesce("land", F.lit(False)))
    clamped = masked.select("r", "c", land_clamp(F.col("z"), F.col("land")).alias("z"))
    coarse = shoal_reduce(clamped, levels)
    land = mask.filter("land").groupBy(F.shiftright("r", levels).alias("r"), F.shiftright("c", levels).alias("c")).agg(F.lit(True).alias("land"))
    coded = coarse.join(land, ["r", "c"], "left").withColumn("z", quantize(F.col("z"), zoom))
    coded = coded.withColumn("code", classify_pixel(F.col("z"), F.coalesce("land", F.lit(False))))
    return coded.groupBy(F.shiftright("r", tile_shift).alias("tile_r"), F.shiftright("c", tile_shift).alias("tile_c"), "code").agg(F.count(F.lit(1)).alias("pixels"), F.min("z").alias("low"), F.max("z").alias("high"))
