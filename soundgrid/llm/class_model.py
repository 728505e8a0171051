"""A language model over classes of words: exchange clustering, class transitions, word emissions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundgrid.llm.common import discard, written
from soundgrid.llm.words import mix, row_groups, text_bytes, word_hashes
from soundgrid.shipping import mapped

_SLICE = 1 << 23


@dataclass
class ClassModel:
    """What ``train`` learns. ``words(word, n, n_all)`` is a table; the arrays are about the frequent words, whose number is bounded."""

    words: DataFrame
    tokens: int
    types: int
    frequent: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    n_classes: int
    rare_tokens: int = 0
    rare_types: int = 0
    discount: float = 0.5
    log_transitions: np.ndarray = field(default_factory=lambda: np.zeros((0, 0, 0)))
    log_likelihoods: list[float] = field(default_factory=list)

    @property
    def rare(self) -> int:
        """The class of words that are too rare for one of their own, and of unknown words."""
        return self.n_classes

    @property
    def end(self) -> int:
        return self.n_classes + 1

    def rare_emission(self, n):
        """Probability of a rare word seen ``n`` times, given their class; an unknown word has what a discount on all rare words sets free."""
        return np.where(n > 0, n - self.discount, self.discount * self.rare_types + 1) / (self.rare_tokens + 1)

    def base(self, n):
        return (n + 0.5) / (self.tokens + 0.5 * (self.types + 1))

    def log_emissions(self) -> np.ndarray:
        """Of each frequent word, given its class."""
        own = self.classes < self.rare
        totals = np.bincount(self.classes[own], self.counts[own], self.n_classes)
        out = self.rare_emission(self.counts)
        out[own] = self.counts[own] / totals[self.classes[own]]
        return np.log10(out)


def _places(frequent: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Each hash's place among the sorted frequent words, or -1."""
    if not len(frequent):
        return np.full(len(hashes), -1)
    own = hashes.view(np.int64)
    at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
    return np.where(frequent[at] == own, at, -1)


def _sequence(place: np.ndarray, firsts: np.ndarray, values: np.ndarray, rare: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of all tokens of a slice, ``end`` after each text, and where each text starts."""
    n = len(firsts) - 1
    out = np.full(len(place) + n, end)
    inner = np.ones(len(out), bool)
    inner[firsts[1:] + np.arange(n)] = False
    out[inner] = np.where(place >= 0, np.append(values, rare)[place], rare)
    return out, firsts[:-1] + np.arange(n)


def _history(codes: np.ndarray, begins: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The token before each token, and the one before that; texts start after two ends."""
    one, two = np.full(len(codes), end), np.full(len(codes), end)
    one[1:], two[2:] = codes[:-1], codes[:-2]
    two[begins] = one[begins] = end
    return one, two


def _slices(batches: Iterator[pa.RecordBatch], text: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Word hashes of some texts at a time, where each text starts, and the rows."""
    for batch in batches:
        done = 0
        for part in row_groups(batch.column(text), _SLICE):
            hashes, _, _, firsts = word_hashes(*text_bytes(part))
            yield hashes, firsts, batch.slice(done, len(part))
            done += len(part)


def word_counts(docs: DataFrame, text: str, learned: Column) -> DataFrame:
    """``word`` (a 64-bit hash, A-Z lowered), ``n`` in the learned rows and ``n_all`` in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, firsts, rows in _slices(batches):
            own = np.repeat(rows.column(1).to_numpy(zero_copy_only=False).astype(bool), np.diff(firsts))
            word, place = np.unique(hashes, return_inverse=True)
            n = np.bincount(place, own, len(word)).astype(np.int64), np.bincount(place, minlength=len(word))
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), *map(pa.array, n)], ["word", "n", "n_all"])

    found = mapped(docs.select(F.col(text).alias("text"), learned.alias("own")), count, "word long, n long, n_all long")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all"))


def word_pairs(docs: DataFrame, text: str, frequent: np.ndarray, clustered: np.ndarray) -> DataFrame:
    """``a, b, n``: how often clustered word ``b`` follows ``a``, as places; -1 is any other word and -2 an end."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, np.where(clustered, np.arange(len(frequent)), -1)))
    wide = len(frequent) + 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, own = shared.value
        for hashes, firsts, _ in _slices(batches):
            codes, begins = _sequence(_places(frequent, hashes), firsts, own, -1, -2)
            before, _ = _history(codes, begins, -2)
            pair, n = np.unique((before + 2) * wide + codes + 2, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], ["pair", "n"])

    found = mapped(docs.select(F.col(text).alias("text")), count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return found.select((F.floor(F.col("pair") / wide) - 2).alias("a"), (F.col("pair") % wide - 2).alias("b"), "n")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def gains(matrix: np.ndarray, now: int, after: np.ndarray, before: np.ndarray, itself: float, n_classes: int) -> np.ndarray:
    """What the log likelihood gains when a word is put into each class, after it was taken out of ``now``.

    ``matrix`` counts the pairs of classes with the word where it is, ``after`` and ``before`` its neighbours by class, without ``itself``, the times it follows
    itself. Only terms that its neighbours touch are worked out.
    """
    left = matrix.copy()
    left[now] -= after
    left[:, now] -= before
    left[now, now] -= itself
    s, p = np.flatnonzero(after), np.flatnonzero(before)
    own = slice(0, n_classes)
    a, b = left[own][:, s], left[p][:, own]
    out = (_xlogx(a + after[s]) - _xlogx(a)).sum(axis=1) + (_xlogx(b + before[p][:, None]) - _xlogx(b)).sum(axis=0)
    d, sd, pd = np.diag(left)[own], after[own], before[own]
    out += _xlogx(d + sd + pd + itself) - _xlogx(d + sd) - _xlogx(d + pd) + _xlogx(d)
    # A class's pairs as first and as second; the word is one of the others' neighbours wherever it is put.
    for axis, new in ((1, after.sum() + itself), (0, before.sum() + itself)):
        total = matrix.sum(axis=axis)
        total[now] -= new
        out -= _xlogx(total[own] + new) - _xlogx(total[own])
    return out


def exchange(pairs: DataFrame, classes: np.ndarray, n_classes: int, rounds: int, share: int) -> tuple[np.ndarray, list[float]]:
    """Exchange clustering of the words whose class is below ``n_classes``; the others stay in class ``n_classes``, ends in the next.

    In each round every ``share``-th word, another part each time, moves to the class where the likelihood of all pairs is greatest, all others being
    where they are. A word's neighbours are added up by class where the pairs lie, so the shuffle has at most two rows a word
    and class, and each word's gains are worked out from them in a task of its own; the driver gets the pairs of classes and the new classes.
    """
    spark, k = pairs.sparkSession, n_classes + 2
    movable = classes < n_classes
    classes, likelihoods, best = classes.copy(), [], (-np.inf, classes)
    for step in range(rounds + 1):
        shared = spark.sparkContext.broadcast(np.append(classes, [n_classes + 1, n_classes]))  # places -2 and -1: ends, other words

        def neighbours(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            of = shared.value
            for batch in batches:
                a, b, n = (c.to_numpy() for c in batch.columns)
                ca, cb = of[a], of[b]
                own = a == b
                word = np.concatenate([a, b[~own], np.full(len(a), -1)])
                key = np.concatenate([np.where(own, 2 * k, cb), k + ca[~own], ca * k + cb])
                code, at = np.unique((word + 2) * (k * k) + key, return_inverse=True)
                times = np.bincount(at, np.concatenate([n, n[~own], n]), len(code)).astype(np.int64)
                keep = code >= k * k  # not the neighbours of ends
                code, times = code[keep], times[keep]
                yield pa.RecordBatch.from_arrays([pa.array(code // (k * k) - 2), pa.array(code % (k * k)), pa.array(times)], ["word", "key", "n"])

        spread = mapped(pairs, neighbours, "word long, key long, n long").groupBy("word", "key").agg(F.sum("n").alias("n"))
        spread = written(spread, "classes")
        cells = spread.filter("word = -1").toArrow()
        matrix = np.zeros(k * k)
        matrix[cells.column("key").to_numpy()] = cells.column("n").to_numpy()
        matrix = matrix.reshape(k, k)
        likelihoods.append(float(_xlogx(matrix).sum() - _xlogx(matrix.sum(axis=0)).sum() - _xlogx(matrix.sum(axis=1)).sum()))
        best = max(best, (likelihoods[-1], classes), key=lambda b: b[0])
        if step == rounds:
            discard(spread)
            break
        state = spark.sparkContext.broadcast((matrix, classes))
        turn = F.pmod(F.xxhash64(F.lit(7), "word"), F.lit(share)) == step % share
        words = spread.filter((F.col("word") >= 0) & turn).groupBy("word").agg(F.collect_list("key").alias("keys"), F.collect_list("n").alias("times"))

        def move(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            matrix, classes = state.value
            for batch in batches:
                words, new = batch.column(0).to_numpy(), []
                for word, keys, times in zip(words.tolist(), batch.column(1), batch.column(2)):
                    row = np.zeros(2 * k + 1)
                    row[keys.values.to_numpy()] = times.values.to_numpy()
                    now = classes[word]
                    gain = gains(matrix, now, row[:k], row[k : 2 * k], row[2 * k], n_classes)
                    top = int(gain.argmax())
                    new.append(top if gain[top] > gain[now] + 1e-9 * max(abs(gain[now]), 1) else now)
                new = np.array(new, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(words[new != classes[words]]), pa.array(new[new != classes[words]])], ["word", "new"])

        moves = mapped(words.filter(F.col("word").isin([]) | F.lit(bool(movable.any()))), move, "word long, new long").toArrow()
        discard(spread)
        if not moves.num_rows and step >= share:
            break
        classes = classes.copy()
        classes[moves.column("word").to_numpy()] = moves.column("new").to_numpy()
    return best[1], likelihoods


def transitions(counts: np.ndarray) -> np.ndarray:
    """Probabilities of the third class after two, from counts of all threes: each history gives way to the shorter one by the number of its different successors."""
    k = len(counts)
    one = counts.sum(axis=(0, 1))
    out = (one + 0.5) / (one.sum() + 0.5 * k)
    for c in (counts.sum(axis=0), counts):
        kinds = np.maximum((c > 0).sum(axis=-1, keepdims=True), 1)
        out = (c + kinds * out) / (c.sum(axis=-1, keepdims=True) + kinds)
    return out


def class_threes(docs: DataFrame, text: str, model: ClassModel) -> np.ndarray:
    """How often each class follows each two others. Tasks count into one array each; arrays meet by place."""
    k = model.n_classes + 2
    shared = docs.sparkSession.sparkContext.broadcast((model.frequent, model.classes, model.rare, model.end))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, classes, rare, end = shared.value
        total = np.zeros(k**3, np.int64)
        for hashes, firsts, _ in _slices(batches):
            codes, begins = _sequence(_places(frequent, hashes), firsts, classes, rare, end)
            one, two = _history(codes, begins, end)
            total += np.bincount((two * k + one) * k + codes, minlength=k**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["three", "n"])

    found = mapped(docs.select(F.col(text).alias("text")), count, "three long, n long").groupBy("three").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(k**3)
    out[found.column("three").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(k, k, k)


def train(docs: DataFrame, learned: Column, text: str = "text", classes: int = 64, rounds: int = 9, share: int = 3, frequent: int = 1 << 18, least: int = 5) -> ClassModel:
    """A class model of the rows of ``docs`` for which ``learned`` is true (null counts as false).

    All words of all rows are counted. Words that make up at least one in ``frequent`` of all tokens (so that many at most) are broadcast as
    arrays; those of them with ``least`` learned tokens or more are dealt into ``classes`` by frequency and then exchanged (see ``exchange``); all other
    words share one class, in which each keeps its own count, and unknown words have the mass that a discount sets free there. Transitions depend on two classes. Texts end with
    a token of its own class. Without learned rows all counts are 0 and every token is unknown.
    """
    learned = F.coalesce(learned, F.lit(False))
    words = written(word_counts(docs, text, learned), "words")
    ends = docs.filter(learned).count()
    some = words.agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all"), F.count_if(F.col("n") > 0).alias("types")).first()
    tokens, types = some["n"] or 0, some["types"]
    head = words.filter(F.col("n_all") >= F.lit((some["n_all"] or 0) / frequent)).orderBy("word").toArrow()
    place, n = head.column("word").to_numpy(), head.column("n").to_numpy().astype(np.float64)
    own = np.flatnonzero(n >= least)
    start = np.full(len(place), classes)
    start[own[np.lexsort((place[own], -n[own]))]] = np.arange(len(own)) % classes
    own_rows = docs.filter(learned)
    likelihoods = []
    if len(own):
        pairs = written(word_pairs(own_rows, text, place, start < classes), "pairs")
        start, likelihoods = exchange(pairs, start, classes, rounds, share)
        discard(pairs)
    clustered = start < classes
    model = ClassModel(words, tokens + ends, types + (ends > 0), place, n, start, classes, log_likelihoods=likelihoods)
    model.rare_tokens, model.rare_types = tokens - int(n[clustered].sum()), types - int(clustered.sum())
    once = words.filter("n in (1, 2)").groupBy("n").count().collect()
    seen = {r["n"]: r["count"] for r in once}
    if seen:
        model.discount = min(max(seen.get(1, 0) / (seen.get(1, 0) + 2 * seen.get(2, 0)), 0.1), 0.9)
    model.log_transitions = np.log10(transitions(class_threes(own_rows, text, model)))
    return model


def scored(docs: DataFrame, model: ClassModel, text: str = "text") -> DataFrame:
    """Log probability of each whole text under the class model and under counts of single words.

    Returns the input's columns but the text, then ``n_tokens`` (words and one end), ``n_known`` (those that the learned rows have),
    ``base_log10`` (words by their own counts, half a token added to each), ``log10_probability`` and ``perplexity`` (of the class model).
    Columns of these names are replaced. A null or empty text is one end; texts are read whole; repeated rows and null ids are rows of their
    own; an empty table gives no rows. Frequent words are scored in one pass where the text lies. The others go, once a text, to a join with the table
    of words: as none of them is frequent, no key of that join is hot. The sums meet the rows by a number that a written table fixes.
    """
    added = ["n_tokens", "n_known", "base_log10", "log10_probability", "perplexity"]
    kept = [c for c in docs.columns if c not in (text, *added)]
    record = F.struct(*(F.col(f"`{c}`") for c in kept)) if kept else F.struct(F.lit(1).alias("none"))
    read = docs.select(F.col(f"`{text}`").alias("text"), F.monotonically_increasing_id().alias("row"), record.alias("record"))
    shared = docs.sparkSession.sparkContext.broadcast((model.frequent, model.counts, model.classes, model.log_emissions(), np.log10(model.base(model.counts)), model.log_transitions, model.rare, model.end))
    ends = model.types and float(np.log10(model.base(_ends(model))))
    unseen = float(np.log10(model.base(0)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts, classes, emissions, bases, moves, rare, end = shared.value
        for hashes, firsts, rows in _slices(batches):
            place = _places(frequent, hashes)
            codes, begins = _sequence(place, firsts, classes, rare, end)
            one, two = _history(codes, begins, end)
            per_text = lambda v: np.diff(np.concatenate([[0.0], np.cumsum(v)])[firsts])
            step = np.add.reduceat(moves[two, one, codes], begins) if len(begins) else np.zeros(0)
            own = place >= 0
            at = np.where(own, place, 0)
            pick = lambda v: per_text(np.where(own, v[at], 0.0)) if len(v) else np.zeros(len(begins))
            tail, times, bounds = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [0]
            for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
                word, n = np.unique(hashes[a:b][~own[a:b]], return_counts=True)
                tail.append(word)
                times.append(n)
                bounds.append(bounds[-1] + len(word))
            others = pa.StructArray.from_arrays([pa.array(np.concatenate(tail).view(np.int64)), pa.array(np.concatenate(times))], ["word", "times"])
            columns = [np.diff(firsts) + 1, pick(counts > 0).round().astype(np.int64), pick(bases), step + pick(emissions)]
            yield pa.RecordBatch.from_arrays([*rows.columns[1:], *map(pa.array, columns), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), others)], [*rows.schema.names[1:], *added[:4], "others"])

    schema = f"row long, record {read.schema['record'].dataType.simpleString()}, n_tokens long, n_known long, base_log10 double, log10_probability double, others array<struct<word: long, times: long>>"
    first = written(mapped(read, score, schema), "scored")
    each = first.select("row", F.inline("others")).join(model.words.select("word", "n"), "word", "left")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("double")
    emission = F.when(n > 0, n - model.discount).otherwise(model.discount * model.rare_types + 1) / (model.rare_tokens + 1)
    base = (n + 0.5) / (model.tokens + 0.5 * (model.types + 1))
    each = each.groupBy("row").agg(F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("known"), F.sum(F.col("times") * F.log10(base)).alias("base"), F.sum(F.col("times") * F.log10(emission)).alias("emission"))
    add = lambda c, d: F.col(c) + F.coalesce(F.col(d), F.lit(0))
    out = first.join(each, "row", "left").withColumns({
        "n_known": add("n_known", "known") + (1 if ends else 0),
        "base_log10": add("base_log10", "base") + (ends or unseen),
        "log10_probability": add("log10_probability", "emission"),
    })
    out = out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("log10_probability") / F.col("n_tokens")))
    return out.select(*(F.col("record").getField(c).alias(c) for c in kept), *added)


def _ends(model: ClassModel) -> int:
    """Learned tokens that are ends."""
    return model.tokens - model.rare_tokens - int(model.counts[model.classes < model.rare].sum())
