"""Periodic runs, the class language model and whitening on odd tables, and against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from soundgrid.llm import class_model, runs, whitening
from soundgrid.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, "go go go go go go stop", "en", "a", 1),
    (1, "go go go go go go stop", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \t\n", "en", None, 3),
    (None, "one TWO one two é 日本 one", "fr", "b", 5),
    (None, None, None, None, None),
    (6, " ".join(["x", "y"] * 30_000), "de", "a", 9),
    (7, "w" * 5000, "de", "a", 9),
]


def documents(spark, rows=ODD):
    docs = spark.createDataFrame(rows, SCHEMA)
    for c in ("runs", "collapsed", "n_tokens", "n_known", "word", "row", "record", "base_log10", "others"):
        docs = docs.withColumn(c, F.lit("extra"))
    return docs


# 11


def brute_runs(words):
    """Every run by walking along each period, each stretch with its smallest period, and the words left."""
    n, seen = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(6, 4 * q):
                seen.setdefault((start, i + q), q)
            i += i == start
    found = sorted((s, q, e - s) for (s, e), q in seen.items())
    dropped = {i for s, q, length in found for i in range(s + q, s + length)}
    return [(s, length, q) for s, q, length in found], " ".join(w for i, w in enumerate(words) if i not in dropped)


def test_runs_equal_those_of_a_walk():
    rng = random.Random(11)
    texts = [None, "", " ", "a", "a a a a a", "a a a a a a", "a b a b a b a b", "a b a b a b a"]
    for _ in range(1500):
        n, letters = rng.randrange(90), rng.choice([1, 2, 3, 20])
        w = [chr(97 + rng.randrange(letters)) for _ in range(n)]
        for _ in range(rng.randrange(3) if n else 0):
            a, p = rng.randrange(n), 1 + rng.randrange(9)
            w[a : a + 7 * p] = (w[a : a + p] * 7)[: len(w[a : a + 7 * p])]
        texts.append(rng.choice([" ", "\n", "\t "]).join(w) + rng.choice(["", " "]))
    found, collapsed = runs._batch(pa.array(texts, pa.string()), 4, 6)
    for text, own, left in zip(texts, found.to_pylist(), collapsed.to_pylist()):
        expected = brute_runs(WORD.findall(text or ""))
        assert ([(r["start"], r["length"], r["period"]) for r in own], left) == expected, text


def test_words_that_only_look_equal_are_told_apart():
    symbols = np.array([5] * 40, np.uint64)
    words = [0] * 40
    calls = []

    def same(a, b, n):
        calls.append(n)
        return len(calls) > 1 and words[a : a + n] == words[b : b + n]

    start, end, period = runs.find_runs(symbols, np.array([0, 40]), same)
    assert (start.tolist(), end.tolist(), period.tolist(), len(calls)) == ([0], [40], [1], 2)


def test_sequences_of_thue_and_morse_have_no_runs():
    text = " ".join("ab"[bin(i).count("1") % 2] for i in range(8192))
    found, collapsed = runs._batch(pa.array([text]), 4, 6)
    assert found.to_pylist() == [[]] and collapsed.to_pylist() == [text]


def test_runs_of_odd_rows(spark):
    docs = documents(spark)
    out = runs.periodic_runs(docs)
    assert out.columns == [c for c in docs.columns if c not in ("runs", "collapsed")] + ["runs", "collapsed"]
    rows = [(r["doc_id"], len(r["runs"]), r["collapsed"]) for r in out.collect()]
    assert len(rows) == len(ODD)
    assert rows.count((1, 1, "go stop")) == 2 and rows.count((2, 0, "")) == 1 and rows.count((None, 0, "")) == 1
    assert (6, 1, "x y") in rows and (7, 0, "w" * 5000) in rows and (4, 0, "") in rows
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_the_query_of_runs_on_whole_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r["doc_id"]: r for r in QUERIES["op11_runs"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for d in docs:
        words, h = WORD.findall(d["text"] or ""), zlib.crc32(str(d["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        own, left = brute_runs(words)
        best = min(own, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        r = found[d["doc_id"]]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(own), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if own else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{length},{q}\n" for s, length, q in own)) and r["collapsed_sha256"] == sha(left)


# 12


def lowered(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]


def test_counts_and_base_scores_equal_brute_force_with_and_without_frequent_words(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    learned = F.col("doc_id") % 3 != 0
    rows = docs.collect()
    counts = Counter(w for r in rows if r["doc_id"] % 3 for w in [*lowered(r["text"]), None])
    n, v = sum(counts.values()), len(counts)
    scores = {}
    for frequent in (1 << 18, 50):
        model = class_model.train(docs, learned, classes=4, rounds=1, share=1, frequent=frequent)
        assert (model.tokens, model.types) == (n, v) and len(model.frequent) <= frequent
        out = {r["doc_id"]: r for r in class_model.scored(docs, model).collect()}
        assert len(out) == len(rows)
        for r in rows:
            words = [*lowered(r["text"]), None]
            base = sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
            own = out[r["doc_id"]]
            assert abs(own["base_log10"] - base) < 1e-7 * len(words) and own["n_tokens"] == len(words) and own["n_known"] == sum(counts[w] > 0 for w in words)
            assert abs(own["perplexity"] / 10 ** (-own["log10_probability"] / len(words)) - 1) < 1e-9
        scores[frequent] = out


def test_probabilities_after_any_history_add_up_to_one(spark):
    docs = spark.createDataFrame([(i, f"a b c a b d a b c x{i} y{i % 7}") for i in range(60)], "doc_id long, text string")
    model = class_model.train(docs, F.col("doc_id") > 9, classes=3, rounds=3, share=1, least=2)
    k = model.n_classes
    counts = {r["word"]: r["n"] for r in model.words.filter("n > 0").collect()}
    of = dict(zip(model.frequent.tolist(), zip(model.classes.tolist(), 10 ** model.log_emissions())))
    emitted = np.zeros(k + 2)
    for word, n in counts.items():
        c, p = of.get(word, (k, float(model.rare_emission(n))))
        emitted[c] += p
    emitted[k] += model.rare_emission(0)  # the unknown word
    emitted[k + 1] = 1
    used = np.unique(model.classes[model.classes < k])
    assert np.allclose(emitted[[*used, k, k + 1]], 1)
    assert np.allclose((10**model.log_transitions).sum(axis=-1), 1)


def test_gains_are_differences_of_the_whole_likelihood():
    rng = np.random.default_rng(3)
    words, k = 9, 3
    pairs = rng.integers(0, 5, (words, words)).astype(float)
    classes = np.append(rng.integers(0, k, words - 2), [k, k + 1])

    def matrix(of):
        out = np.zeros((k + 2, k + 2))
        np.add.at(out, (of[:, None], of[None, :]), pairs)
        return out

    def likelihood(of):
        m = matrix(of)
        f = lambda x: sum(v * np.log(v) for v in np.ravel(x) if v > 0)
        return f(m) - f(m.sum(0)) - f(m.sum(1))

    for w in range(words - 2):
        after, before = np.zeros(k + 2), np.zeros(k + 2)
        for u in range(words):
            if u != w:
                after[classes[u]] += pairs[w, u]
                before[classes[u]] += pairs[u, w]
        gain = class_model.gains(matrix(classes), classes[w], after, before, pairs[w, w], k)
        moved = [likelihood(np.where(np.arange(words) == w, c, classes)) for c in range(k)]
        assert np.allclose(gain - gain[0], np.array(moved) - moved[0])


def test_exchange_finds_the_classes_of_a_grammar(spark):
    rng = random.Random(5)
    kinds = [[f"{c}{i}" for i in range(8)] for c in "nvd"]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(kinds[j % 3]) for j in range(60))) for i in range(200)], "doc_id long, text string")
    model = class_model.train(docs, F.col("doc_id") >= 20, classes=3, rounds=12, share=3)
    assert model.log_likelihoods[-1] > model.log_likelihoods[0]
    out = class_model.scored(docs.filter("doc_id < 20"), model).agg(F.sum("log10_probability").alias("model"), F.sum("base_log10").alias("base"), F.sum("n_tokens").alias("n")).first()
    assert out["model"] / out["n"] > out["base"] / out["n"] + 0.3


def test_the_model_beats_single_words_on_held_out_documents(spark, sf_dir):
    out = QUERIES["op12_class_model"](spark, sf_dir).filter("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base"), F.sum("n_tokens").alias("n"), F.min("train_tokens").alias("n0")).first()
    assert out["n0"] > 0 and out["score"] > out["base"]


def test_the_class_model_on_odd_and_empty_tables(spark):
    docs = documents(spark)
    model = class_model.train(docs, F.col("doc_id") != 4, classes=2, rounds=1, share=1, least=1)
    out = class_model.scored(docs, model)
    assert out.columns == [c for c in docs.columns if c not in ("text", "n_tokens", "n_known", "base_log10")] + ["n_tokens", "n_known", "base_log10", "log10_probability", "perplexity"]
    rows = out.collect()
    assert sorted(r["n_tokens"] for r in rows) == [1, 1, 1, 1, 2, 8, 8, 8, 60_001] and all(np.isfinite(r["log10_probability"]) and r["perplexity"] >= 1 for r in rows)
    assert {r["word"] for r in rows} == {"extra"}
    nobody = class_model.train(docs, F.lit(False))
    assert (nobody.tokens, nobody.types) == (0, 0)
    assert all(r["n_known"] == 0 and np.isfinite(r["log10_probability"]) and r["base_log10"] == 0 for r in class_model.scored(docs, nobody).collect())
    assert class_model.scored(docs.limit(0), class_model.train(docs.limit(0), F.lit(True))).count() == 0


# 13


def test_rotations_find_the_eigenvalues_and_small_ones_accurately():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 8, 33):
        a = rng.normal(size=(d, d))
        a = a + a.T
        values, axes = whitening.jacobi(a)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1]) and np.allclose(axes @ axes.T, np.eye(d)) and np.allclose(axes @ a @ axes.T, np.diag(values))
    scale = 10.0 ** -np.arange(0, 24, 4)
    turn = np.eye(6) + 0.1 * np.ones((6, 6))
    graded = scale[:, None] * turn * scale
    values, _ = whitening.jacobi(graded)
    exact = [Fraction(graded[i][i]) for i in range(6)]
    assert abs(np.prod([v / float(e) for v, e in zip(values, exact)]) - np.linalg.det(turn) / 1.1**6) < 1e-12  # the determinant, to full relative accuracy
    assert whitening.jacobi(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]


def test_whitening_equals_an_eigendecomposition_of_all_rows(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.array([[int(np.floor(1024 * float(c))) + 100000 for c in r["embedding"]] for r in rows])
    n, total = len(x), x.sum(axis=0)
    values, axes = np.linalg.eigh((x - total / n).T @ (x - total / n) / n)
    expected = (x - total / n) @ axes[:, ::-1][:, :8] / np.sqrt(values[::-1][:8])
    out = QUERIES["op13_whitening"](spark, sf_dir).collect()
    assert len(out) == 8 * n and {r["n"] for r in out} == {n} and max(r["identity_error"] for r in out) < 1e-10
    own, place = np.zeros((n, 8)), {r["vec_id"]: i for i, r in enumerate(rows)}
    for r in out:
        i = place[r["vec_id"]]
        own[i, r["component"] - 1] = r["whitened"]
        assert r["deviation"] == sum((n * int(c) - int(s)) ** 2 for c, s in zip(x[i], total))
        assert abs(r["explained"] - values[-r["component"]] / values.sum()) < 1e-10
    assert np.allclose(own * np.sign((own * expected).sum(axis=0)), expected, atol=1e-8)


def test_whitening_of_odd_and_empty_tables(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 1.0]), (None, [0.0, 5.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0]), (8, []), (9, [2.0, 2.5])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>").withColumn("whitened", F.lit("extra"))
    model = whitening.fit(df)
    out = whitening.whitened(df, model, 5)
    assert out.columns == ["vec_id", "vector", "whitened"] and sorted((r["vec_id"] or 0) for r in out.collect()) == [0, 1, 1, 2, 9]
    assert model.n == 5 and whitening.identity_error(df, model, 5) < 1e-12 and abs(model.explained.sum() - 1) < 1e-12
    flat = df.filter("vec_id = 1")
    assert [r["whitened"] for r in whitening.whitened(flat, whitening.fit(flat), 5).collect()] == [[], []]
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], "vec_id long, vector array<double>")
    assert {len(r["whitened"]) for r in whitening.whitened(line, whitening.fit(line), 5).collect()} == {1}
    none = df.limit(0)
    empty = whitening.fit(none)
    assert empty.n == 0 and whitening.whitened(none, empty, 8).count() == 0 and whitening.identity_error(none, empty, 8) == 0.0
