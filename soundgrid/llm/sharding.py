"""Global shuffle and sharding of records by a two-pass external shuffle. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundgrid.llm.common import prefix_offsets, written

#: Columns that the operator adds.
ADDED = ("size", "bucket", "position", "shard", "slot")


def shuffled_shards(docs: DataFrame, shards: int = 16, seed: int = 17, bucket_bytes: int = 16 << 20, max_buckets: int = 1 << 20, text: str = "text") -> DataFrame:
    """Put every record at a uniformly random place of a global order and cut that order into ``shards``.

    Pass one scatters the records uniformly into buckets of about ``bucket_bytes`` by a seeded hash of the
    record's id and its place in the input, so that copies of one record, a hot source
    or a hot key spread like any other rows; an input that is dealt into other partitions gets another order. Pass two sorts each bucket by that hash, which makes it independent of the
    order of arrival, shuffles it by ``shuffle`` (Fisher-Yates with a seed) and writes it to the shared folder.
    A bucket fits in memory; no task ever holds more than one. The order of all records is the order of the
    buckets, then the place in the bucket; shard ``s`` takes the ``s``-th of ``shards`` equal stretches, so
    each bucket touches two shards at most and the shards' counts differ by one at most (law ``rows``).

    Returns the input's columns and ``size`` (UTF-8 bytes of the text plus 1; a null text has 1), ``bucket``,
    ``position`` in the bucket, ``shard`` and ``slot`` (gapless from 0 in each shard). An input column with
    one of these names is replaced. Repeated rows are separate records, nulls are kept as they are, empty
    texts have size 1, columns of any type (maps, too) are passed on, an empty table gives an empty result, a text of any length is one record.
    ``max_buckets`` bounds the table of bucket offsets, which is broadcast (16 bytes a bucket).
    """
    docs = docs.drop(*ADDED)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    total = docs.agg(F.sum(size)).first()[0] or 0
    buckets = int(min(max_buckets, max(1, -(-total // bucket_bytes))))
    place = F.xxhash64(F.lit(seed), *([F.col("doc_id")] if "doc_id" in docs.columns else []), F.monotonically_increasing_id())
    record = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("record"), size.alias("size"), F.pmod(place, F.lit(buckets)).cast("int").alias("bucket"), place.alias("_place"))
    scattered = record.repartitionById(buckets, F.col("bucket"))
    by_place = lambda a, b: F.when(a["_place"] < b["_place"], -1).when(a["_place"] > b["_place"], 1).otherwise(0)
    packed = scattered.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("_place", "size", "record")), by_place).alias("rows"))
    mixed = packed.select("bucket", F.posexplode(F.shuffle("rows", seed)).alias("position", "row"))
    mixed = written(mixed.select("bucket", F.col("position").cast("long").alias("position"), "row.size", "row.record"), "shuffled")
    counts = mixed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    n = counts.agg(F.sum("n")).first()[0] or 0
    starts = prefix_offsets(counts, "bucket", ["n"]).select("bucket", F.col("n_before").alias("_start"))
    at = F.col("_start") + F.col("position")
    shard = F.floor(at * shards / n) if n * shards >= 1 << 53 else F.floor((at * shards).cast("double") / max(n, 1))
    shard = F.least(shard, F.lit(shards - 1)).cast("int")
    placed = mixed.join(F.broadcast(starts), "bucket").withColumn("_at", at).withColumn("shard", shard)
    first = F.ceil(F.col("shard").cast("long") * n / shards).cast("long")
    return placed.select("record.*", "size", "bucket", "position", "shard", (F.col("_at") - first).alias("slot"))
