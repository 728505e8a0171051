"""Sinks over any storage that Spark can write."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soundgrid.functions.tiles import hilbert_id


def fingerprint(df: DataFrame) -> tuple[int, int]:
    """Rows and an order-free sum of row hashes."""
    row = F.xxhash64(*(F.to_json(F.struct(c)) for c in sorted(df.columns)))
    n, s = df.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)"))).first()
    return n, int(s or 0)


def write_if_changed(df: DataFrame, path: str) -> bool:
    """Write under a new version and then move the pointer, unless what is there holds the same rows. Whether it wrote."""
    spark = df.sparkSession
    before = read_latest(spark, path)
    if before is not None and before.schema.simpleString() == df.schema.simpleString() and fingerprint(before) == fingerprint(df):
        return False
    try:
        version = spark.read.text(f"{path}/_pointer").select(F.max(F.col("value").cast("int"))).first()[0] or 0
    except AnalysisException:
        version = 0
    df.write.mode("overwrite").parquet(f"{path}/v{version + 1}")
    # The pointer is written last, so a reader sees a whole version or the one before.
    spark.createDataFrame([(str(version + 1),)], "value string").coalesce(1).write.mode("append").text(f"{path}/_pointer")
    return True


def read_latest(spark: SparkSession, path: str) -> DataFrame | None:
    """The version that the pointer names; None before the first."""
    try:
        version = spark.read.text(f"{path}/_pointer").select(F.max(F.col("value").cast("int"))).first()[0]
    except AnalysisException:
        return None
    return spark.read.parquet(f"{path}/v{version}")


def archive(tiles: DataFrame, zoom: int) -> DataFrame:
    """Tiles of one zoom with their Hilbert number, range-partitioned and sorted by it, so files hold stretches of the curve."""
    return tiles.withColumn("tile_id", hilbert_id(zoom, F.col("x"), F.col("y"))).repartitionByRange("tile_id").sortWithinPartitions("tile_id")


def archive_header(tiles: DataFrame) -> DataFrame:
    return tiles.agg(F.min("z").alias("minzoom"), F.max("z").alias("maxzoom"), F.min("x").alias("left"), F.max("x").alias("right"), F.min("y").alias("top"), F.max("y").alias("bottom"), F.count(F.lit(1)).alias("tiles"))


def content_address(name: F.Column, content: F.Column) -> F.Column:
    """The name and the first twelve hex digits of its content's SHA-256."""
    return F.concat(name, F.lit("-"), F.substring(F.sha2(content, 256), 1, 12))


def unreferenced(listing: DataFrame, referenced: DataFrame, key: str) -> DataFrame:
    """What may be deleted; ``refused`` is true on all rows where something referenced isn't listed, and then nothing may be."""
    missing = referenced.select(key).distinct().join(listing.select(key), key, "left_anti").agg((F.count(F.lit(1)) > 0).alias("refused"))
    return listing.select(key).distinct().join(referenced.select(key), key, "left_anti").crossJoin(missing)


def mosaic_index(tiles: DataFrame, artifacts: DataFrame, sources: DataFrame) -> DataFrame:
    """One index row a tile with what it was made of: ``stem, location, sources, priority, missing``.

    ``tiles(stem, source)`` has a row for each source of a tile, ``artifacts(stem, location)`` what is there, ``sources(source, priority)``.
    ``missing`` marks tiles without an artifact.
    """
    known = tiles.select("stem", "source").distinct().join(sources.select("source", "priority"), "source", "left")
    rows = known.groupBy("stem").agg(F.array_join(F.sort_array(F.collect_set("source")), ",").alias("sources"), F.max(F.coalesce("priority", F.lit(0))).alias("priority"))
    there = artifacts.groupBy("stem").agg(F.min("location").alias("location"))
    return rows.join(there, "stem", "left").select("stem", "location", "sources", "priority", F.col("location").isNull().alias("missing"))


def write_index(index: DataFrame, path: str) -> bool:
    """Write ``mosaic_index`` rows as ``write_if_changed`` does; an index with missing tiles is refused whole."""
    lost = index.filter("missing").select("stem").limit(5).collect()
    if lost:
        raise ValueError("index incomplete, no artifact of " + ", ".join(r["stem"] for r in lost))
    return write_if_changed(index.drop("missing"), path)


def stranded(artifacts: DataFrame) -> DataFrame:
    """Artifacts (``path, kind, size, readable``) to take from the listing, with the reason: tiles that can't be read, and archives without bytes. Other empty outputs stand for dry tiles and stay."""
    why = F.when((F.col("kind") == "tile") & ~F.coalesce("readable", F.lit(False)), "unreadable").when((F.col("kind") == "archive") & (F.coalesce("size", F.lit(0)) == 0), "empty")
    return artifacts.select("path", why.alias("reason")).filter("reason is not null")
