"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks. DataFrame operations only."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soundgrid.llm.common import WORD, prefix_offsets, written

#: A schedule has at most so many slots; the product of two of their numbers fits in 64 bits.
MAX_SLOTS = 1 << 31


def word_count(text: str | Column) -> Column:
    """Words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def level_targets(sources: DataFrame, share: float, cap: str) -> DataFrame:
    """Deal ``share`` of all sizes to ``sources(source, source_size, weight)`` by weight, at most ``cap`` to each.

    What a capped source can't take goes to the others by weight, until none is above its cap: the level at which caps
    and shares meet is found from running sums over the sources in the order in which they would reach their caps.
    Adds ``source_no`` (by code point, null last) and ``target``, drops ``cap``. One row a source: few enough for one task's window.
    """
    everything = Window.partitionBy()
    numbered = sources.withColumn("source_no", F.row_number().over(everything.orderBy(F.asc_nulls_last("source"))) - 1)
    filling = everything.orderBy(F.try_divide(F.col(cap).cast("double"), F.col("weight")), "source_no")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    level = F.try_divide(left, F.sum("weight").over(rest))
    levelled = numbered.withColumn("_level", level).withColumn("_turn", F.row_number().over(filling))
    open_turn = F.when(F.col("_level") * F.col("weight") <= F.col(cap), F.col("_turn"))
    met = F.min_by("_level", open_turn).over(everything)
    target = F.least(F.col(cap).cast("double"), F.coalesce(F.greatest(met, F.lit(0.0)) * F.col("weight"), F.col(cap).cast("double")))
    return levelled.withColumn("target", target).drop(cap, "_level", "_turn")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Targets of ``sizes(source, source_size)``: ``share`` of all sizes dealt by weight, each at most ``cap`` times its source.

    Sources in code-point order, null last, take ``weights`` in turn. A source without words has target 0.
    """
    turn = F.row_number().over(Window.partitionBy().orderBy(F.asc_nulls_last("source"))) - 1
    weighed = sizes.withColumn("weight", F.get(F.array(*(F.lit(float(w)) for w in weights)), turn % len(weights)))
    return level_targets(weighed.withColumn("_cap", F.col("source_size") * F.lit(cap)), share, "_cap")


def block_schedule(targets: DataFrame, block_words: int = 4096, chunk: int = 1 << 16) -> tuple[DataFrame, int]:
    """The order in which blocks of ``targets(source_no, source_size, target)`` are read, and the block length.

    A source is a stream of blocks of equal length, the last one shorter; it is read again from its start when
    it ends, and stops after ``target`` words. Slot ``i`` of ``T`` stands at the golden-ratio point
    ``i*g/T mod 1`` (``g`` is the number next to ``T`` over the golden ratio that has no common divisor with
    ``T``), and belongs to the source whose stretch of the cumulative weights holds that point. These points
    are a permutation of the fractions ``j/T``, so each source gets exactly the slots that it needs, evenly
    spread. Slots are made from the source's side, by the inverse of the map, and ranked in each source by
    slot: ranks inside chunks of slots, plus sums over the chunks.

    Returns ``slot, source_no, rank, block, epoch, from_word, to_word`` (words of the source's stream), one row
    a slot. Where the targets hold over ``MAX_SLOTS`` blocks, blocks grow so that they don't.
    """
    words = targets.agg(F.sum("target")).first()[0] or 0
    length = int(max(block_words, -(-words // MAX_SLOTS) + 1 if words > MAX_SLOTS * block_words else block_words))
    goal, size = F.round("target").cast("long"), F.col("source_size")
    blocks = F.ceil(size / length).cast("long")
    whole = F.when(size > 0, F.floor(goal / size)).otherwise(0).cast("long")
    rest = goal - whole * size
    need = targets.select("source_no", size.alias("source_size"), goal.alias("goal"), blocks.alias("blocks"), (whole * blocks + F.ceil(rest / length)).cast("long").alias("slots"))
    need = written(prefix_offsets(need, "source_no", ["slots"]), "slots")
    total = need.agg(F.sum("slots")).first()[0] or 0
    step = round(total * 0.6180339887498949) or 1
    while total and gcd(step, total) != 1:
        step += 1
    back = pow(step, -1, total) if total > 1 else 0
    parts = need.filter("slots > 0").withColumn("_part", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / chunk).cast("int"))))
    parts = parts.repartition("source_no", "_part")
    point = F.explode(F.sequence(F.col("_part") * F.lit(chunk).cast("long"), F.least(F.col("slots"), (F.col("_part") + 1) * F.lit(chunk).cast("long")) - 1))
    slots = parts.withColumn("_j", point).withColumn("slot", F.pmod((F.col("_j") + F.col("slots_before")) * F.lit(back).cast("long"), F.lit(max(total, 1)).cast("long")))
    slots = slots.withColumn("_chunk", F.floor(F.col("slot") / chunk))
    counts = slots.groupBy("source_no", "_chunk").agg(F.count(F.lit(1)).alias("n"))
    starts = prefix_offsets(counts, "_chunk", ["n"], ["source_no"]).select("source_no", "_chunk", "n_before")
    inner = F.row_number().over(Window.partitionBy("source_no", "_chunk").orderBy("slot")) - 1
    ranked = slots.withColumn("_inner", inner).join(starts, ["source_no", "_chunk"]).withColumn("rank", F.col("_inner") + F.col("n_before"))
    ranked = ranked.withColumn("block", F.pmod("rank", "blocks")).withColumn("epoch", F.floor(F.col("rank") / F.col("blocks")).cast("long"))
    begin = F.col("block") * length
    end = F.least(begin + length, F.col("source_size"), F.col("goal") - F.col("epoch") * F.col("source_size"))
    return ranked.select("slot", "source_no", "rank", "block", "epoch", begin.alias("from_word"), end.alias("to_word")), length


def repeated(df: DataFrame, times: str, as_copy: str, step: int = 4096) -> DataFrame:
    """Each row ``times`` times, with a number from 1 as ``as_copy``. Two steps, as one array of all numbers could be too long."""
    outer = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / step).cast("long")))
    inner = F.explode(F.sequence(F.col("_step") * step + 1, F.least(F.col(times).cast("long"), (F.col("_step") + 1) * step)))
    return df.filter(F.col(times) > 0).withColumn("_step", outer).withColumn(as_copy, inner).drop("_step")


def mixed(docs: DataFrame, targets: DataFrame | None = None, block_words: int = 4096, seed: int = 23, salts: int = 32) -> DataFrame:
    """What a mix takes of each document of ``docs(source, doc_id, size)``.

    Each source's documents stand in a seeded random order in its stream; their words are cut into equal
    blocks, and joined with the slots that ``block_schedule`` gives those blocks. A document's ``taken`` is the
    number of its words in all slots, words of repeated blocks counted again. Running positions come from sums
    over hash ranges and inside each range, so neither a hot source nor many copies of one row meet in a task:
    rows that agree in source, id and size are summed first, and dealt apart again at the end.

    Returns a row for each input row: ``source, doc_id, size, source_size, target, taken``. Null sources are one
    source, null ids are ids like others, documents without words take nothing, an empty table gives no rows.
    """
    runs = written(docs.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies")), "sizes")
    if targets is None:
        targets = source_targets(runs.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size")))
    targets = written(targets.select("source", "source_no", "source_size", "target"), "targets")
    slots, length = block_schedule(targets, block_words)
    ranges = max(64, -(-runs.count() // 100_000))
    salt = F.pmod(F.xxhash64("doc_id", "size"), F.lit(salts))
    keyed = targets.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    runs, keyed = runs.withColumn("_salt", salt).alias("r"), keyed.alias("k")
    runs = runs.join(keyed, F.col("r.source").eqNullSafe(F.col("k.source")) & (F.col("r._salt") == F.col("k._salt")))
    runs = runs.select("r.source", "doc_id", "size", "copies", "source_no", "source_size", "target")
    runs = runs.withColumn("_hash", F.xxhash64(F.lit(seed), "doc_id", "size")).withColumn("_range", F.pmod("_hash", F.lit(ranges)))
    runs = runs.withColumn("_words", F.col("size") * F.col("copies"))
    totals = runs.groupBy("source_no", "_range").agg(F.sum("_words").alias("words"))
    starts = prefix_offsets(totals.withColumnRenamed("_range", "range_no"), "range_no", ["words"], ["source_no"])
    starts = starts.select("source_no", F.col("range_no").alias("_range"), F.col("words_before").alias("_start"))
    inside = Window.partitionBy("source_no", "_range").orderBy("_hash", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.withColumn("_before", F.coalesce(F.sum("_words").over(inside), F.lit(0))).join(starts, ["source_no", "_range"])
    rows = repeated(placed, "copies", "copy").withColumn("_at", F.col("_start") + F.col("_before") + (F.col("copy") - 1) * F.col("size"))
    rows = rows.select("source", "doc_id", "size", "copy", "source_no", "source_size", "target", "_at")
    last = F.floor((F.col("_at") + F.greatest(F.col("size"), F.lit(1)) - 1) / length)
    pieces = rows.withColumn("block", F.explode(F.sequence(F.floor(F.col("_at") / length), last)))
    read = slots.select("source_no", "block", "from_word", "to_word")
    overlap = F.least("to_word", F.col("_at") + F.col("size")) - F.greatest("from_word", "_at")
    hits = pieces.join(read, ["source_no", "block"], "left").withColumn("_taken", F.when(F.col("from_word").isNull(), 0).otherwise(F.greatest(overlap, F.lit(0))))
    return hits.groupBy("source", "doc_id", "size", "copy", "source_size", "target").agg(F.sum("_taken").alias("taken")).drop("copy")
