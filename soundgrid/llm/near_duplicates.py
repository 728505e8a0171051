"""Groups of near-duplicate texts by SetSketch registers: band, estimate by likelihood, verify on full sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from soundgrid.llm.common import discard, written
from soundgrid.llm.words import mix, row_groups, shingles, text_bytes, word_hashes
from soundgrid.operators.graph import components
from soundgrid.operators.skew import join_by_key
from soundgrid.shipping import mapped

REGISTERS = 128
#: Registers of one band. Two sets of similarity 0.75 share none of 32 bands with a probability of 5e-6.
BAND = 4
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
_SALTS = mix(np.arange(REGISTERS // 2, dtype=np.uint64) + np.uint64(0x5E75E7C4))
#: So many of a pair's 256 register bits differ, at most, at similarity 0.75 or more, but for one pair in over a million.
MOST_BITS = 64
#: A pair is dropped unverified if its likelihood at the threshold is below the greatest one by e to this power (five standard deviations).
LEAST_LIKELIHOOD = 12.5
#: Nodes of a bucket that one task compares with as many others.
PART = 2048


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes: ``floor(1 - log_b(m))`` of the least of its elements' exponential values, in ``[0, TOP]``.

    The least of two sets' registers' values, which is the greater register, is the register of their union.
    """
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(hashes), 2048):
        x = hashes[a : a + 2048, None] ^ _SALTS[None, :]
        x = x * np.uint64(0x9FB21C651E98DF25)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xD6E8FEB86659FD93)
        np.minimum(least, x.view(np.uint32).reshape(len(x), -1).min(axis=0), out=least)
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def _set_key(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def similarity_likelihood(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Joint maximum-likelihood similarity of pairs of sketches, and whether the threshold is plausible.

    Of the registers of a pair, the numbers of greater, smaller and equal ones are multinomial with
    probabilities that follow from both sizes and the similarity.
    """
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    same = REGISTERS - more - less
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    cap = np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = p(u - v * j), p(v - u * j)
        log = lambda x: np.log(np.maximum(x, 1e-9))
        return more * log(up) + less * log(down) + same * log(1 - up - down)

    grid = np.linspace(0, 1, 51)[None, :] * cap
    at = likelihood(grid)
    best = at.argmax(axis=1)
    rows = np.arange(len(best))
    found = grid[rows, best]
    fits = (cap[:, 0] >= threshold) & ((found >= threshold) | (likelihood(np.minimum(threshold, cap))[:, 0] >= at[rows, best] - LEAST_LIKELIHOOD))
    return found, fits


def _sketched(docs: DataFrame) -> DataFrame:
    """Each row's number and id, its text, all its columns as ``record``, and its set's key, size and registers."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("record"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, sketches = [], [], []
            for part in row_groups(batch.column(2)):
                hashes, _, _, firsts = word_hashes(*text_bytes(part))
                for own in shingles(hashes, firsts):
                    sizes.append(len(own))
                    keys.append(_set_key(own) if len(own) else None)
                    sketches.append(registers(own).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())], [*batch.schema.names, "set_key", "n_shingles", "sketch"])

    added = [StructField("set_key", BinaryType()), StructField("n_shingles", LongType()), StructField("sketch", BinaryType())]
    return mapped(numbered, run, StructType([*numbered.schema.fields, *added]))


def _banded(classes: DataFrame) -> DataFrame:
    """``node, key``: one row for each band of each set's sketch."""
    order = np.arange(REGISTERS // BAND, dtype=np.uint64)[None, :] << np.uint64(48)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS // BAND, BAND)
            key = mix(mix(sketches.view(np.uint64)[:, :, 0]) ^ order).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), key.shape[1])), pa.array(key.ravel())], ["node", "key"])

    return mapped(classes.select("node", "sketch"), run, "node long, key long")


def _with_bits(classes: DataFrame) -> DataFrame:
    """Adds ``bits``: two hashed bits of each register, in four longs, for a quick look at pairs."""
    salts = mix(np.arange(REGISTERS, dtype=np.uint64) + np.uint64(977))[None, :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("sketch")
            sketches = np.frombuffer(b"".join(batch.column(at).to_pylist()), np.uint16).reshape(-1, REGISTERS)
            two = mix(sketches.astype(np.uint64) ^ salts)
            packed = np.packbits(np.concatenate([two & np.uint64(1), two >> np.uint64(1) & np.uint64(1)], axis=1).astype(bool), axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(np.arange(len(packed) + 1, dtype=np.int32) * 4), pa.array(packed.ravel()))], [*batch.schema.names, "bits"])

    return mapped(classes, run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema), "bits array<long>"]))


def _close(x: str, y: str, percent: int) -> F.Column:
    """Sizes and register bits allow the threshold."""
    differing = sum((F.bit_count(F.col(f"{x}.bits")[i].bitwiseXOR(F.col(f"{y}.bits")[i])) for i in range(1, 4)), F.bit_count(F.col(f"{x}.bits")[0].bitwiseXOR(F.col(f"{y}.bits")[0])))
    small, large = F.least(f"{x}.n_shingles", f"{y}.n_shingles"), F.greatest(f"{x}.n_shingles", f"{y}.n_shingles")
    return (small * 100 >= large * percent) & (differing <= MOST_BITS)


def _plausible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """``a, b, similarity`` of the pairs whose joint likelihood allows the threshold."""
    side = lambda s: sketches.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, len(batch), 4096)):
                a, b = (np.frombuffer(b"".join(part.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (4, 5))
                found, fits = similarity_likelihood(a, b, part.column(2).to_numpy().astype(float), part.column(3).to_numpy().astype(float), percent / 100)
                table = pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found)], ["a", "b", "similarity"])
                yield table.filter(pa.array(fits))

    return mapped(joined, run, "a long, b long, similarity double")


def _compared(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``a, b, linked, common, size_b, novel, missing`` of each pair, from both full shingle sets.

    ``common`` is the size of both sets' intersection, ``novel`` has 32 bits of each shingle of ``a`` that ``b`` hasn't, and
    ``missing`` marks in 512 bits the shingles of ``b`` that ``a`` hasn't.
    """
    side = lambda s: texts.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}"))
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")

    def sets(column: pa.Array) -> list[np.ndarray]:
        return [own for group in row_groups(column) for own in shingles(*(lambda h: (h[0], h[3]))(word_hashes(*text_bytes(group))))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, len(batch), 256)):
                linked, common, size, novel, marks = [], [], [], [], np.zeros((len(part), 512), bool)
                for i, (x, y) in enumerate(zip(sets(part.column(2)), sets(part.column(3)))):
                    both = np.intersect1d(x, y, assume_unique=True)
                    common.append(len(both))
                    size.append(len(y))
                    marks[i, (np.setdiff1d(y, both, assume_unique=True) & np.uint64(511)).astype(np.int64)] = True
                    linked.append(len(both) > 0 and len(both) * 100 >= percent * (len(x) + len(y) - len(both)))
                    novel.append(np.setdiff1d(x, both, assume_unique=True).astype(np.uint32).view(np.int32))
                missing = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * 8), pa.array(np.packbits(marks, axis=1).view(np.int64).ravel()))
                columns = [pa.array(linked, pa.bool_()), pa.array(common, pa.int64()), pa.array(size, pa.int64()), pa.array(novel, pa.list_(pa.int32())), missing]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], ["a", "b", "linked", "common", "size_b", "novel", "missing"])

    return mapped(joined, run, "a long, b long, linked boolean, common long, size_b long, novel array<int>, missing array<long>")


def _within_reach(common: F.Column, shared: F.Column, size: F.Column, other: F.Column, percent: int) -> F.Column:
    """Whether a set of ``size`` can have the similarity with one of size ``other``, if they share ``common + shared`` shingles at most."""
    return (common + shared) * (100 + percent) >= (size + other) * percent


def _best(pairs: DataFrame, of: str, n: int) -> DataFrame:
    order = Window.partitionBy(of).orderBy(F.desc("similarity"), "a", "b")
    return pairs.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= n).drop("_place")


def _classed(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, int]:
    """The sketched rows, a row for each different set (``set_key, first, n, node, label``), and the rows with a set.

    ``first`` is the smallest ``(id is null, id, row)`` of a set's ``n`` rows, ``label`` is the same for the sets of one group.
    """
    if percent < 75:
        raise ValueError("the bands and bounds hold for a similarity of 75 % or more")
    sketched = written(_sketched(docs), "sketches")
    classes = sketched.filter(F.col("set_key").isNotNull()).groupBy("set_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("n"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    n_classes, n_rows = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()

    bands = written(_banded(classes), "bands")
    met = written(bands.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("least")).filter("n > 1"), "met")
    buckets = written(join_by_key(bands, met, "key", n_classes * REGISTERS // BAND).select("key", "node", "least"), "buckets")
    discard(bands, met)
    active = classes.join(buckets.select("node").distinct(), "node", "left_semi").select("node", F.col("first.row").alias("row"), "n_shingles", "sketch")
    active = written(_with_bits(active), "active")
    texts = written(sketched.select("row", "text").join(active.select("node", "row"), "row").select("node", "text"), "texts")

    star = buckets.filter("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    likeliest = _best(_plausible(star, active, percent), "a", 1)
    first_links = written(_compared(likeliest, texts, percent).filter("linked").select("a", "b"), "links")
    labels = components(first_links)

    degree = first_links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    labelled = buckets.select("key", "node").join(degree, "node", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    mixed = _mixed(labelled, labels, F.max(F.struct("degree", "node")).alias("hub")).select("key", "node", F.col("hub.node").alias("hub"))
    by_hub = written(mixed.filter("node <> hub"), "mixed")
    profiles = written(_compared(by_hub.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), texts, percent), "profiles")
    links = written(first_links.unionByName(profiles.filter("linked").select("a", "b")), "links")
    discard(buckets, first_links)
    labels = components(links)

    known = active.select("node", "n_shingles", "bits")
    mixed = written(_mixed(by_hub.join(known, "node"), labels, F.min("n_shingles").alias("fewest")), "mixed")
    left = profiles.withColumnsRenamed({"a": "node", "b": "hub"}).join(mixed.select("node", "hub").distinct(), ["node", "hub"], "left_semi")
    novel = written(left.select("node", "hub", F.explode("novel").alias("shingle")).select("node", "hub", F.xxhash64("hub", "shingle").alias("of_hub")), "novel")
    elsewhere = written(novel.groupBy("of_hub").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "elsewhere")
    shared = join_by_key(novel, elsewhere, "of_hub", novel.count()).groupBy("node", "hub").agg(F.count(F.lit(1)).alias("shared"))
    profile = left.select("node", "hub", "common", "size_b", "missing").join(shared, ["node", "hub"], "left").withColumn("shared", F.coalesce("shared", F.lit(0)))
    able = mixed.join(profile, ["node", "hub"]).filter(_within_reach(F.col("common"), F.col("shared"), F.col("n_shingles"), F.greatest("fewest", F.ceil(F.col("n_shingles") * percent / 100)), percent))
    able = written(able.drop("fewest"), "able")
    discard(novel, elsewhere, profiles, by_hub, mixed)
    last = _compared(_plausible(_last_pairs(able, percent), active, percent), texts, percent)
    every_link = written(links.unionByName(last.filter("linked").select("a", "b")), "links")
    discard(links, able, active, texts)
    grouped = written(classes.join(components(every_link), "node", "left").withColumn("label", F.coalesce("label", "node")).drop("sketch"), "grouped")
    discard(classes, every_link)
    return sketched, grouped, int(n_rows)


def _last_pairs(able: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of the pairs of nodes of one bucket and different groups that sizes, bits and profiles leave.

    A bucket's main group isn't compared within itself. Nodes of a large bucket are dealt into parts of about ``PART``, and a task compares two parts.
    """
    sized = able.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups")).filter("groups > 1")
    labelled = join_by_key(able, written(sized, "sized"), "key", able.count())
    parts = F.ceil(F.col("n") / PART).cast("int")
    own, every = F.pmod(F.xxhash64("node"), parts).cast("int"), F.explode(F.sequence(F.lit(0), parts - 1))
    dealt = written(labelled.withColumn("part", own), "dealt")
    minor, rest = dealt.filter("label <> main").withColumn("other", every).alias("x"), dealt.withColumn("other", every).alias("y")
    once = (F.col("y.label") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    # Of the hub, both miss at least as many shingles as either one's bits show.
    missed = sum((F.bit_count(F.col("x.missing")[i].bitwiseOR(F.col("y.missing")[i])) for i in range(8)), F.lit(0))
    reach = _within_reach(F.least("x.common", "y.common", F.col("x.size_b") - missed), F.least("x.shared", "y.shared"), F.col("x.n_shingles"), F.col("y.n_shingles"), percent)
    together = (F.col("x.key") == F.col("y.key")) & (F.col("x.part") == F.col("y.other")) & (F.col("x.other") == F.col("y.part"))
    pairs = minor.join(rest, together & (F.col("x.label") != F.col("y.label")) & once & reach & _close("x", "y", percent))
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Each document's group of near duplicates.

    Texts are linked if ``100 * |A & B| >= percent * |A | B|`` for their sets of five-word shingles (words lowered in
    A-Z; a text of fewer words is one shingle). One row a row of ``docs``: ``doc_id, n_shingles, component_id`` (smallest
    id reachable over links) and ``kept`` (the document has that id). Documents without words are linked with nothing.
    Rows that repeat an id and a text share its group; nulls in ``doc_id`` are never a group's id unless it has no
    other; an empty table gives no rows; other columns don't matter; texts of any length are read whole. ``percent`` is 75 at least.

    Equal sets are one node from the start. Nodes that share a band of registers are candidates. All pairs of a
    bucket are never made; links are sought in three rounds, and in each only between nodes that the rounds before left in
    different groups: each node with the likeliest of its buckets' smallest nodes; each node with its buckets' hubs, the nodes
    with most links; and at last every pair that may still be a link. What two nodes have in common is in the hub or not: of the
    hub they share no more than either has of it, and of the rest no more than either's shingles that some other node compared
    with that hub has, too. Nodes and then pairs that fall short by that, or by sizes, by register bits or by the joint likelihood of
    their registers, are ruled out. So groups are those of all links, and every link is confirmed on both full sets.
    What a bucket has in common is found by aggregation, and no task gets a large bucket's or a frequent set's rows (``join_by_key``).
    """
    sketched, classes, n_rows = _classed(docs.select("doc_id", "text"), percent)
    least = classes.groupBy("label").agg(F.min("first").alias("least"))
    of_set = classes.join(least, "label").select("set_key", F.col("least.doc_id").alias("component_id"), "n")
    rows = sketched.select("doc_id", "n_shingles", "set_key")
    grouped = join_by_key(rows.filter(F.col("set_key").isNotNull()), written(of_set, "sets"), "set_key", n_rows)
    alone = rows.filter(F.col("set_key").isNull()).withColumn("component_id", F.col("doc_id"))
    columns = ("doc_id", "n_shingles", "component_id")
    return grouped.select(*columns).unionByName(alone.select(*columns)).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``docs``, all columns, that are left if one row of each group of near duplicates stays (see ``near_duplicates``).

    A row is what stays or goes, not an id: of a group the row with the smallest id stays, a null id being the greatest, and of equal
    ids the row that comes first. So of repeated rows one stays, an id that stands on rows of several groups stays once in each for which
    it is the smallest, and no group is lost. Every row without words stays.
    """
    sketched, classes, _ = _classed(docs, percent)
    stay = classes.groupBy("label").agg(F.min("first").alias("first")).select("first.row")
    left = sketched.filter(F.col("set_key").isNotNull()).join(stay, "row", "left_semi").unionByName(sketched.filter(F.col("set_key").isNull()))
    return left.select(*(F.col("text") if c == "text" else F.col("record").getField(c).alias(c) for c in docs.columns))


def _mixed(buckets: DataFrame, labels: DataFrame, *facts: F.Column) -> DataFrame:
    """The rows of buckets whose nodes are in several groups, with their groups (``label``) and ``facts`` of the bucket."""
    labelled = written(buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
    of_key = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"), *facts)
    return join_by_key(labelled, written(of_key.filter("low <> high"), "of_key"), "key", labelled.count()).drop("low", "high", "n")
