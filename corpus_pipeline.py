"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Toxic documents go, one row of each group of near duplicates stays, documents that hold a benchmark passage go,
sources are repeated towards their target weights, and what is left is shuffled into shards. Every stage but the last
returns the columns of ``documents``. Nulls, empty texts and empty tables are those of the operators. Every stage decides on
rows, not on ids: rows that repeat an id are as good as others, and so are those with a null id. Extra columns
are passed on as they are, whatever their names (sharding replaces those that it adds, see there).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from soundgrid.llm import decontamination, mixing, near_duplicates, sharding, toxicity
from soundgrid.llm.common import written

#: Sources' weights are their words to this power, so small sources are repeated more often than large ones.
FLATTENING = 0.5
SHARE, CAP = 1.5, 2.0
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``TOXIC``."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    packed = docs.select("text", F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("record"))
    left = toxicity.toxicity(packed, model).filter(F.col("toxicity_score") < TOXIC)
    return left.select(*(F.col("text") if c == "text" else F.col("record").getField(c).alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near duplicates, and rows without words."""
    return near_duplicates.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.without_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def row_key(docs: DataFrame) -> F.Column:
    """Two hashes of all of a row's columns and of which of them are null, as hashes alone pass over nulls.

    Columns with parts of their own are hashed as text that keeps nulls, so values that stand in other parts differ and maps have a hash, too.
    """
    text = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    parts = []
    for f in docs.schema:
        c = F.col(f"`{f.name}`")
        nested = isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))
        parts += [c.isNull(), F.to_json(F.struct(c.alias("c")), text) if nested else c]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once for each time that the mix reads them.

    Every source is read once at least, so no document is lost; what ``SHARE`` of all words leaves over that goes to the
    sources by weight, to ``CAP`` times a source's words at most. A document whose last reading is cut off by the
    target is in it if half of its words are. A row is known by ``row_key``; rows that agree in all are read as rows of their own. Columns of any type, maps too, are passed on.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(row_key(docs).alias("doc_id"), F.struct(*columns).alias("record"))
    sized = keyed.select("record.source", "doc_id", mixing.word_count("record.text").alias("size"))
    totals = written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    weights = totals.withColumn("weight", F.pow(F.col("source_size").cast("double"), F.lit(FLATTENING)))
    extra = mixing.level_targets(weights.withColumn("_room", F.col("source_size") * (CAP - 1)), SHARE - 1, "_room")
    taken = mixing.mixed(sized, extra.withColumn("target", F.col("source_size") + F.col("target")))
    twice = taken.filter((F.col("taken") >= 1.5 * F.col("size")) & (F.col("size") > 0)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("times"))
    different = keyed.groupBy("doc_id").agg(F.first("record").alias("record"))
    return docs.unionByName(mixing.repeated(different.join(twice, "doc_id"), "times", "copy").select("record.*"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's shard and slot in a global shuffle."""
    return sharding.shuffled_shards(docs, shards=16)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Classifiers and sketches aren't SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None
QUERIES, ORACLES = {"pipeline": run}, {}
