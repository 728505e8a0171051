"""The corpus operators applied to whole tables: one query each, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soundgrid.llm import class_model, decontamination, language, licenses, mixing, near_duplicates, neighbours, quality, runs, sharding, tokens, toxicity, whitening
from soundgrid.llm.common import fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(folds: int, left_out: int) -> F.Column:
    return F.coalesce(fold(F.col("doc_id"), folds) == left_out, F.lit(False)).alias("held_out")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    score = F.col("quality_score")
    return scored.select("doc_id", held_out(5, 0), score.alias("score"), (score >= 0.3).cast("int").alias("predicted"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.languages(docs.select("doc_id", "text"), language.train(docs))
    return found.select("doc_id", held_out(4, 2), "lang_pred", F.col("lang_score").alias("score"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.shuffled_shards(docs, shards=16)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return placed.select("doc_id", "size", crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), percent=75)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mixed(docs.select("source", "doc_id", mixing.word_count("text").alias("size"))).select("doc_id", "size", "source_size", "target", "taken")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.benchmark_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    score = F.col("toxicity_score")
    return scored.select("doc_id", held_out(5, 0), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op10_tokens(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    counted = tokens.prefix_tokens(docs, public_tokenizers.path(vocabulary))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def periodic_tails(docs: DataFrame) -> DataFrame:
    """Every tenth text with its words repeated from some word on, as the contract of ``op11_runs`` has it; the others as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    read = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, split).alias("words"))
    n, g = F.size("words"), F.col("g")
    first = F.pmod(g, n)
    period = F.lit(1) + F.floor((n - first) / (F.lit(3) + F.pmod(g, F.lit(8))))
    read = read.select("doc_id", "text", "words", *(F.when(n > 0, c).cast("int").alias(a) for c, a in ((first, "first"), (period, "period"))))
    again = lambda w, i: F.when(i < F.col("first"), w).otherwise(F.get("words", F.col("first") + F.pmod(i - F.col("first"), F.col("period"))))
    return read.select("doc_id", F.when(F.col("period").isNotNull(), F.array_join(F.transform("words", again), " ")).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(periodic_tails(table(spark, sf_dir, "documents"))).select("doc_id", "runs", F.sha2("collapsed", 256).alias("collapsed_sha256"))
    better = lambda a, b: (b["length"] * a["period"] > a["length"] * b["period"]) | ((b["length"] * a["period"] == a["length"] * b["period"]) & (F.struct(b["start"], b["period"]) < F.struct(a["start"], a["period"])))
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(better(a, b), b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    found = found.withColumn("best", best)
    milli = F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period"))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", milli.alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), "collapsed_sha256")


def op12_class_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out(5, 1), "text")
    model = class_model.train(docs, ~F.col("held_out"))
    found = class_model.scored(docs, model)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), F.col("base_log10").alias("base_score"), F.col("log10_probability").alias("score"), "perplexity")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").filter(whitening.usable("embedding"))
    whole = vectors.select("vec_id", F.transform("embedding", lambda c: F.floor(c.cast("double") * 1024) + 100000).alias("vector"))
    model = whitening.fit(whole)
    out = whitening.whitened(whole, model, 8)
    sums = F.array(*(F.lit(s).cast("long") for s in model.sums)) if model.sums else F.lit(None).cast("array<long>")
    off = F.transform(F.arrays_zip(F.col("vector").alias("x"), sums.alias("s")), lambda z: z["x"] * model.n - z["s"])
    deviation = F.aggregate(off, F.lit(0).cast("long"), lambda s, z: s + z * z)
    explained = F.array(*(F.lit(float(e)) for e in model.explained)) if model.sums else F.lit(None).cast("array<double>")
    out = out.select("vec_id", deviation.alias("deviation"), F.posexplode("whitened").alias("component", "whitened"))
    error = whitening.identity_error(whole, model, 8)
    return out.select("vec_id", (F.col("component") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.get(explained, "component").alias("explained"), F.lit(error).alias("identity_error"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_neighbours, op2_licenses, op3_quality, op4_language, op5_sharding, op6_near_duplicates, op7_mixing, op8_decontamination, op9_toxicity, op10_tokens, op11_runs, op12_class_model, op13_whitening)}
ORACLES: dict[str, str] = {}
