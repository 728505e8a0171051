"""Each corpus operator on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns, and against brute force."""

import itertools
import json
import random
import re
import textwrap
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from soundgrid.llm import decontamination, language, licenses, mixing, near_duplicates, neighbours, quality, sharding, tokens, toxicity
from soundgrid.llm.queries import QUERIES
from soundgrid.llm.words import mix, text_bytes, word_hashes
from soundgrid.operators import graph

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def sentence(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["river", "stone", "walks", "under", "seven", "lights", "paper", "quiet", "north", "glass"]) + str(rng.randrange(60)) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, exact and near copies, repeated rows."""
    base = sentence(1, 80)
    words = base.split()
    near = " ".join(["changed", *words[1:]])
    return [
        (0, base, "en", "a", 1),
        (1, base.upper(), "en", "a", 1),
        (2, near, "en", "b", 1),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \t\n", "en", None, 3),
        (6, "one two", None, "c", 7),
        (7, "One  TWO", "de", "c", 7),
        (8, sentence(2, 40_000), "de", "a", 9),
        (8, sentence(2, 40_000), "de", "a", 9),
        (None, sentence(3, 50), "fr", "a", 5),
        (None, None, None, "z", None),
        (9, sentence(4, 30) + " é日本 😀", "fr", "a", 5),
        (10, "12345 --- !!!", "fr", "a", 5),
    ]


def documents(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)


def clashing(docs):
    """Extra columns with the names that operators add or use inside."""
    for c in ("size", "shard", "slot", "bucket", "position", "set_key", "node", "label", "key", "token_steps", "n_tokens", "toxicity_score", "quality_score", "quality_features", "lang_pred", "lang_score", "taken", "target", "item_id"):
        docs = docs.withColumn(c, F.lit("extra"))
    return docs


# words


def test_words_are_those_of_the_pattern():
    texts = [t for _, t, *_ in odd_rows()] + ["\x0b\x0c a\x1cb  C\n", "x"]
    hashes, _, _, firsts = word_hashes(*text_bytes(pa.array(texts, pa.string())))
    by_hash, by_word = {}, {}
    for i, t in enumerate(texts):
        own = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(t or "")]
        found = hashes[firsts[i] : firsts[i + 1]].tolist()
        assert len(own) == len(found)
        for w, h in zip(own, found):
            assert by_hash.setdefault(h, w) == w and by_word.setdefault(w, h) == h


def test_a_word_longer_than_a_piece_and_sliced_columns():
    texts = ["tail", "x" * 600_000 + " y", "y", None, "x" * 600_000]
    column = pa.array(texts, pa.string())
    hashes, _, _, firsts = word_hashes(*text_bytes(column.slice(1)))
    assert np.diff(firsts).tolist() == [2, 1, 0, 1] and hashes[0] == hashes[3] and hashes[1] == hashes[2]


# 1


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def brute_nearest(rows, k):
    seen = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            seen.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    ids = np.array([i for i, vs in seen.items() for _ in vs])
    every = np.array([v for vs in seen.values() for v in vs]).reshape(len(ids), -1)
    out = {}
    for q in (i for i in seen if i % 20 == 0):
        best = {}
        for i, s in zip(ids.tolist(), (every * min(seen[q], key=tuple)).sum(axis=1).tolist()):
            if i != q:
                best[i] = max(s, best.get(i, s))
        out[q] = [(i, s) for s, i in sorted((-s, i) for i, s in best.items())[:k]]
        out[q] = [(i, -s) for i, s in out[q]]
    return out


def test_neighbours_of_odd_vectors(spark):
    """Ranks and scores wherever found, with equal vectors in several blocks and ids with several vectors."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(200)]
    rows += [(i, rows[40][1]) for i in range(200, 260)] + [(7, rows[7][1]), (9, rng.normal(size=8).astype(np.float32).tolist()), (40, rng.normal(size=8).astype(np.float32).tolist())]
    rows += [(300, None), (320, [0.0] * 8), (340, [float("nan")] * 8), (360, [float("inf")] + [1.0] * 7), (380, [None] + [1.0] * 7), (None, [1.0] * 8), (400, [1.0, 2.0])]
    table = vectors(spark, rows).withColumn("score", F.lit("clash"))
    truth = brute_nearest([r for r in rows if not (r[1] and len(r[1]) == 2)], 20)
    for block, query_block in ((64, 4), (7, 1000)):
        found = neighbours.nearest(table, table.filter("vec_id % 20 = 0"), k=20, block=block, query_block=query_block, epsilon=4.0).orderBy("query_id", "rank").collect()
        got = {}
        for r in found:
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert got == truth
        assert all([r["rank"] for r in found if r["query_id"] == q] == list(range(1, 21)) for q in truth)


def test_estimates_count_bits():
    """Counted bits give the inner products with the rounded query, for dimensions beside the word's, too."""
    rng = np.random.default_rng(5)
    for dim in (8, 64, 100):
        turned, bits = rng.normal(size=(30, dim)), rng.normal(size=(50, dim)) > 0
        got, rounding = neighbours.estimates(turned, neighbours.packed_bits(bits), dim)
        exact = turned @ (np.where(bits, 1, -1) / np.sqrt(dim)).T
        assert np.abs(got - exact).mean() < 1.2 * rounding.mean() and (np.abs(got - exact) < 5 * rounding[:, None]).all()


def test_no_stage_of_the_search_is_dealt_by_the_query_alone(spark, sf_dir):
    plan = QUERIES["op1_neighbours"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    plan = plan.replace("\n", " ")
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert sum("block#" in d and "part#" in d for d in dealt) == 2 and not any("part#" in d and "block#" not in d for d in dealt)


def test_neighbours_of_few_and_no_vectors(spark):
    few = vectors(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5])])
    assert [tuple(r) for r in neighbours.nearest(few, few.filter("vec_id % 20 = 0")).collect()] == [(0, 1, 1, 0.5)]
    assert neighbours.nearest(few.limit(0), few.limit(0)).count() == 0


def test_neighbours_recall(spark, sf_dir):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    truth = brute_nearest(rows, 20)
    got = QUERIES["op1_neighbours"](spark, sf_dir).collect()
    assert sum(r["vec_id"] in {i for i, _ in truth[r["query_id"]]} for r in got) >= 0.99 * sum(map(len, truth.values()))


# 2


def test_license_statements(spark):
    rows = [
        (1, "Intro\nReleased under the MIT License.\nend", None, None, None),
        (2, "licensed under the apache  license, VERSION 2.0", None, None, None),
        (3, "Licensed under the Apache License, Version 1.1.", None, None, None),
        (4, "This work is licensed under the GNU General Public License, version 3. All rights reserved.", None, None, None),
        (5, "This work is licensed under the GNU General Public License, version 2.", None, None, None),
        (6, "we got permission to leave", None, None, None),
        (7, None, None, None, None),
        (8, "", None, None, None),
        (9, sentence(5, 5000) + " Licensed under CC BY-NC 4.0. " + sentence(6, 5000), None, None, None),
        (None, "Released under the MIT License.", None, None, None),
    ]
    found = {(r["doc_id"], r["license"]) for r in licenses.license_scan(clashing(documents(spark, rows))).collect()}
    assert found == {(1, "MIT"), (2, "Apache-2.0"), (4, "GPL-3.0"), (4, "All rights reserved"), (5, "GPL-2.0"), (9, "CC-BY-NC-4.0"), (None, "MIT")}
    assert licenses.license_scan(documents(spark, [])).count() == 0


def test_license_differences():
    assert licenses.differences("a b c x e".split(), "b c d e".split()) == (1, 1, 5)
    assert licenses.differences("q".split(), "a b".split())[0] == 2


def test_license_statements_wrapped_over_lines(spark):
    rows, expected = [], set()
    for k in ("MIT (permission)", "BSD (conditions)", "ISC", "Apache-2.0 (header)", "GPL-3.0", "Unlicense", "MPL-2.0"):
        for width, prefix in ((80, ""), (30, " * "), (24, "# ")):
            expected.add((len(rows), k))
            rows.append((len(rows), "x = 1\n" + "\n".join(prefix + line for line in textwrap.wrap(licenses.TEMPLATES[k][0], width)) + "\ny = 2", None, None, None))
    got = licenses.license_scan(documents(spark, rows)).collect()
    assert {(r["doc_id"], r["license"]) for r in got} == expected and len(got) == len(rows)
    assert {r["line"] for r in got if r["license"] == "MIT (permission)"} == {1}


def test_license_statements_in_other_short_words(spark):
    texts = {
        "Licensed under the MIT License.": {"MIT"},
        "This project is released under MIT": {"MIT (short)"},
        "// SPDX-License-Identifier: MIT": {"MIT (SPDX)"},
        "SPDX-License-Identifier: GPL-2.0-or-later": {"GPL-2.0-or-later (SPDX)"},
        "Available under the BSD 3-Clause License": {"BSD-3-Clause"},
        "Released under the BSD 4-Clause License": set(),
        "licensed under CC BY NC 4.0": set(),
        "Some rights reserved.": set(),
        "all\nrights reserved": {"All rights reserved"},
    }
    got = licenses.license_scan(documents(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])).collect()
    assert {(r["doc_id"], r["license"]) for r in got} == {(i, k) for i, v in enumerate(texts.values()) for k in v}
    # Each of several statements of a block is found once, also where a long block is cut.
    many = "\n".join(f"file {i}: Released under the MIT License." for i in range(6000))
    lines = [r["line"] for r in licenses.license_scan(documents(spark, [(1, many, None, None, None)])).collect()]
    assert sorted(lines) == list(range(6000))


def test_templates_longer_than_the_words_around_a_cue_are_found_whole(spark):
    """One cue, at the first or the last word, and words inserted into the wording."""
    long = " ".join(f"word{i}" for i in range(150))
    templates = {"first": (f"copyright {long}", "word7"), "last": (f"{long} copyright", "word7")}
    broken = " ".join(w + (" extra" if i % 10 == 0 else "") for i, w in enumerate(f"copyright {long}".split()))
    rows = [(i, t, None, None, None) for i, t in enumerate([f"x y copyright {long} z", f"x {long} copyright z", f"{broken} z", f"copyright {long[:400]}"])]
    got = licenses.license_scan(documents(spark, rows), templates).collect()
    assert sorted((r["doc_id"], r["license"], r["n_differences"]) for r in got if r["n_differences"] != 1) == [(0, "first", 0), (1, "last", 0), (2, "first", 15)]


def test_toxic_dictionaries_have_room_for_all_their_words():
    rng = random.Random(6)
    marked = [f"{''.join(rng.choice('bcdfgklmnprst') for _ in range(9))}" for _ in range(900)]
    plain = [sentence(i, 30) for i in range(300)]
    texts = plain + [" ".join(w for j in range(20) for w in (f"near{(i * 7 + j) % 97}", marked[(i * 20 + j) % 900])) for i in range(400)]
    model = toxicity.fit(texts, np.array([False] * 300 + [True] * 400), (1.0, 1.0), base_bytes=4096, segments=((24, 6),))
    assert len(model.toxic[0]) > 8000 and all(w.encode() in model.toxic[0] for w in marked)


def test_license_scan_finds_all_plain_lines(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).filter("line like '%Released under the MIT License.%'").select("doc_id").distinct()
    found = QUERIES["op2_licenses"](spark, sf_dir).filter("license = 'MIT'").select("doc_id").distinct()
    assert {r[0] for r in lines.collect()} == {r[0] for r in found.collect()}


# 3, 4, 9


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (4000, 3))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 2] > 0.9)).astype(float)
    model = quality.fit(x[:3000], y[:3000], pairs=2)
    assert (model.pairs[0] == (1, 0)) and ((model.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
    bins = model.bins(x[:5])
    by_hand = [model.intercept + sum(t[b[j]] for j, t in enumerate(model.tables)) + sum(t[b[i], b[j]] for (i, j), t in zip(model.pairs, model.pair_tables)) for b in bins]
    assert np.allclose(model.logits(x[:5]), by_hand)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("labels", [[], [(0, 1, 1), (1, 0, 0), (2, None, None), (None, 1, 1), (6, 1, 0), (6, 0, 1), (9, 1, 0), (3, 1, 1)]])
def test_classifiers_on_odd_rows(spark, labels):
    docs, marks = clashing(documents(spark)), labels_of(spark, labels)
    scored = quality.quality(docs.drop("size"), quality.train(documents(spark), marks)).collect()
    assert len(scored) == len(odd_rows()) and all(0 <= r["quality_score"] <= 1 for r in scored)
    scored = toxicity.toxicity(docs, toxicity.train(documents(spark), marks)).collect()
    assert len(scored) == len(odd_rows()) and all(0 <= r["toxicity_score"] <= 1 for r in scored)
    found = language.languages(docs, language.train(documents(spark))).collect()
    assert len(found) == len(odd_rows()) and all(0 <= r["lang_score"] <= 1 for r in found)
    assert {r["lang_pred"] for r in found if r["doc_id"] in (3, 4, 5, 10)} == {"und"}


def test_classifiers_on_empty_tables(spark):
    empty, none = documents(spark, []), labels_of(spark, [])
    assert quality.quality(empty, quality.train(empty, none)).count() == 0
    assert toxicity.toxicity(empty, toxicity.train(empty, none)).count() == 0
    assert language.languages(empty, language.train(empty)).count() == 0
    one = documents(spark, [(1, "some text", "en", "a", 9)])
    assert language.languages(one, language.train(empty)).first()["lang_pred"] == "und"


def test_held_out_folds_are_never_learned_from(spark, sf_dir):
    docs, marks = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = [r[0] for r in marks.select("doc_id").collect() if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    flipped = marks.withColumn("quality", F.when(F.col("doc_id").isin(held), 1 - F.col("quality")).otherwise(F.col("quality"))).withColumn("toxic", F.when(F.col("doc_id").isin(held), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = quality.train(docs, marks), quality.train(docs, flipped)
    assert all(np.array_equal(x, y) for x, y in zip(a.tables, b.tables))
    a, b = toxicity.train(docs, marks), toxicity.train(docs, flipped)
    assert a.toxic == b.toxic and np.array_equal(a.weights, b.weights)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    marks = spark.read.parquet(f"{sf}/labels.parquet")
    q = QUERIES["op3_quality"](spark, sf).filter("held_out").join(marks, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert q > 0.97
    t = QUERIES["op9_toxicity"](spark, sf).filter("held_out").join(marks, "doc_id").groupBy("toxic").agg(F.avg("predicted")).collect()
    rate = {r[0]: r[1] for r in t}
    assert rate[1] > 0.65 and rate[0] < 0.02  # a tenth of these labels stand on texts without a marked word
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    right = QUERIES["op4_language"](spark, sf).filter("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98


def test_rare_languages_are_in_a_balanced_sample(spark):
    from soundgrid.llm.common import balanced_sample

    rows = [(i, "en" if i % 50 else "fy" if i % 100 else None) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, lang string")
    got = {r[0]: r[1] for r in balanced_sample(df, "doc_id", "lang", 600, 7).groupBy("lang").count().collect()}
    assert got["fy"] == 60 and got[None] == 60 and 320 < got["en"] <= 480
    assert balanced_sample(df, "doc_id", "lang", 6000, 7).count() == 6000 and balanced_sample(df.limit(0), "doc_id", "lang", 9, 7).count() == 0


def test_language_weights_are_sparse_and_calibrated(spark, sf_dir):
    model = language.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert 0 < (model.weights != 0).mean() < 0.5 and model.temperature > 0


def test_toxic_windows_cut_no_word():
    text = sentence(9, 500)
    assert b" ".join(b"".join(w for w in toxicity.windows(text, 100)).split()) == text.encode()


# 5


def test_shards_of_odd_rows(spark):
    docs = clashing(documents(spark))
    out = sharding.shuffled_shards(docs, shards=4, bucket_bytes=1 << 16)
    rows = out.collect()
    assert sorted(repr(r["doc_id"]) for r in rows) == sorted(repr(r[0]) for r in odd_rows())
    counts = {}
    for r in rows:
        counts.setdefault(r["shard"], []).append(r["slot"])
        assert r["size"] == len((r["text"] or "").encode()) + 1
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in counts.values())
    assert len({r["bucket"] for r in rows}) > 1
    again = sharding.shuffled_shards(docs, shards=4, bucket_bytes=1 << 16).collect()
    key = lambda rs: sorted((repr(r["doc_id"]), repr(r["source"]), r["shard"], r["slot"]) for r in rs)
    assert key(rows) == key(again)
    assert sharding.shuffled_shards(documents(spark, [])).count() == 0


def test_one_row_repeated_spreads_over_buckets(spark):
    docs = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same " * 20).alias("text"))
    out = sharding.shuffled_shards(docs, bucket_bytes=20_000)
    per = [r["count"] for r in out.groupBy("bucket").count().collect()]
    assert len(per) > 20 and max(per) < 3 * min(per)


# 6


def brute_components(rows, percent=75):
    """Each row's set and the number of its group's first row."""
    sets = []
    for i, t, *_ in rows:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(t or "")]
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    find = lambda x: x if group[x] == x else find(group[x])
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                group[find(a)] = find(b)
    return sets, [find(k) for k in range(len(rows))]


def brute_groups(rows, percent=75):
    sets, group = brute_components(rows, percent)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[group[k]] = min(least.get(group[k], r[0]), r[0])
    return sorted((repr(r[0]), len(sets[k]), repr(least.get(group[k]))) for k, r in enumerate(rows))


def brute_left(rows, percent=75):
    """Ids and texts' groups of the rows that stay: the smallest id of each group, and every row without words."""
    sets, group = brute_components(rows, percent)
    least = {}
    for k, r in enumerate(rows):
        if sets[k]:
            least[group[k]] = min(least.get(group[k], (True, 0)), (r[0] is None, r[0] or 0))
    return sorted([(repr(None if none else i), g) for g, (none, i) in least.items()] + [(repr(r[0]), -1) for k, r in enumerate(rows) if not sets[k]])


def test_groups_of_odd_rows(spark):
    got = near_duplicates.near_duplicates(clashing(documents(spark))).collect()
    assert sorted((repr(r["doc_id"]), r["n_shingles"], repr(r["component_id"])) for r in got) == brute_groups(odd_rows())
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert near_duplicates.near_duplicates(documents(spark, [])).count() == 0


def test_groups_of_chains_and_stars(spark):
    rng = random.Random(4)
    rows, i = [], 0
    for g in range(12):
        base = sentence(100 + g, rng.choice([6, 12, 60, 150])).split()
        for _ in range(rng.choice([1, 2, 25, 40])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                own[rng.randrange(len(own))] = f"edit{rng.randrange(10**6)}"
            rows.append((i, " ".join(own), None, None, None))
            i += 1
            if rng.random() < 0.3:
                base = own
    got = near_duplicates.near_duplicates(documents(spark, rows)).collect()
    assert sorted((repr(r["doc_id"]), r["n_shingles"], repr(r["component_id"])) for r in got) == brute_groups(rows)


def repeated_ids():
    t = [sentence(700 + k, 40) for k in range(6)]
    rows = [(5, t[0]), (7, t[0]), (5, t[1]), (3, t[1]), (8, t[2]), (8, t[2]), (None, t[0]), (None, t[3]), (None, t[3]), (2, t[4]), (2, "lead " + t[4]), (2, t[5]), (9, None), (9, None), (4, ""), (None, " ")]
    return [(i, text, "en", "a", k) for k, (i, text) in enumerate(rows)]


@pytest.mark.parametrize("rows", [[], odd_rows(), repeated_ids()])
def test_one_row_of_each_group_stays(spark, rows):
    docs = clashing(documents(spark, rows)).withColumn("record", F.lit(1)).withColumn("row", F.lit("clash"))
    left = near_duplicates.without_near_duplicates(docs)
    assert left.columns == docs.columns
    texts = {(repr(i), t): g if own else -1 for (i, t, *_), own, g in zip(rows, *brute_components(rows))}
    assert sorted((repr(r["doc_id"]), texts[repr(r["doc_id"]), r["text"]]) for r in left.collect()) == brute_left(rows)


def test_large_buckets_are_dealt_into_parts(spark, monkeypatch):
    """Many different near copies of one text in one bucket, beside chains to other groups, with every key hot and with none."""
    from soundgrid.operators import skew

    rng, rows = random.Random(12), []
    bases = [sentence(900, 60).split()]
    for g in range(6):  # chains of bases, each near enough to share bands with the one before
        own = list(bases[-1])
        for _ in range(4):
            own[rng.randrange(60)] = f"turn{rng.randrange(10**6)}"
        bases.append(own)
    for i in range(240):
        own = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 2, 3])):
            own[rng.randrange(60)] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(own), None, None, None))
    monkeypatch.setattr(near_duplicates, "PART", 8)
    join = skew.join_by_key
    for share in (1, 300, 10**9):
        monkeypatch.setattr(near_duplicates, "join_by_key", lambda *a, s=share, **k: join(*a, **k, share=s))
        got = near_duplicates.near_duplicates(documents(spark, rows)).collect()
        assert sorted((repr(r["doc_id"]), r["n_shingles"], repr(r["component_id"])) for r in got) == brute_groups(rows)
    with pytest.raises(ValueError):
        near_duplicates.near_duplicates(documents(spark, rows), percent=50)


def test_groups_of_the_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op6_near_duplicates"](spark, sf_dir).collect()
    assert sorted((repr(r["doc_id"]), r["n_shingles"], repr(r["component_id"])) for r in got) == brute_groups(rows)


def test_registers_merge_and_estimate():
    values = mix(np.arange(1, 3001, dtype=np.uint64))
    a, b = values[:2000], values[400:2600]
    merged = near_duplicates.registers(np.union1d(a, b))
    assert np.array_equal(merged, np.maximum(near_duplicates.registers(a), near_duplicates.registers(b)))
    found, fits = near_duplicates.similarity_likelihood(near_duplicates.registers(a)[None], near_duplicates.registers(b)[None], np.array([2000.0]), np.array([2200.0]), 0.75)
    assert abs(found[0] - 1600 / 2600) < 0.15
    same, fits = near_duplicates.similarity_likelihood(merged[None], merged[None], np.array([9.0]), np.array([9.0]), 0.75)
    assert same[0] == 1 and fits[0]


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, 501), (502, 501), (600, 600)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {k: 0 for k in range(201)} | {500: 500, 501: 500, 502: 500}


# 7


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


def check_mix(rows, got):
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(WORD.findall(r[1] or ""))
    target, taken = brute_targets(sizes), {}
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - target[r["source"]]) < 1e-6 * max(1, target[r["source"]])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)


def test_mix_of_odd_rows(spark):
    docs = documents(spark)
    sized = clashing(docs).drop("size").withColumn("size", mixing.word_count("text"))
    check_mix(odd_rows(), mixing.mixed(sized, block_words=64).collect())
    assert mixing.mixed(sized.limit(0)).count() == 0
    silent = documents(spark, [(1, None, None, "a", 0), (2, "", None, None, 0)]).withColumn("size", mixing.word_count("text"))
    assert [r["taken"] for r in mixing.mixed(silent).collect()] == [0, 0]


def test_mix_of_the_documents_and_again(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    source = {r[0]: r[3] for r in rows}
    a = [r.asDict() | {"source": source[r["doc_id"]]} for r in QUERIES["op7_mixing"](spark, sf_dir).collect()]
    check_mix(rows, a)
    b = QUERIES["op7_mixing"](spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in a) == sorted((r["doc_id"], r["taken"]) for r in b)


def test_schedule_is_spread_evenly(spark):
    targets = spark.createDataFrame([(0, 10_000, 15_000.0), (1, 4_000, 5_000.0), (2, 500, 500.0), (3, 0, 0.0)], "source_no int, source_size long, target double")
    slots, length = mixing.block_schedule(targets, block_words=10, chunk=128)
    rows = sorted(slots.collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in rows] == list(range(2050)) and length == 10
    for s, n in ((0, 1500), (1, 500), (2, 50)):
        own = [r for r in rows if r["source_no"] == s]
        assert [r["rank"] for r in own] == list(range(n)) and sum(r["to_word"] - r["from_word"] for r in own) == n * 10
        share, seen = n / 2050, 0
        for k, r in enumerate(rows):
            seen += r["source_no"] == s
            assert abs(seen - share * (k + 1)) < 5


# 8


def test_passages_with_substitutions(spark):
    rng = random.Random(8)
    items = [(i, sentence(1000 + i, rng.choice([8, 16, 40]))) for i in range(20)] + [(90, None), (91, ""), (92, "too short to say much"), (93, sentence(1000, 8))]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    rows, truth = [], set()
    for k, (i, t) in enumerate(items[:20]):
        own = t.split()
        if len(own) > 20:
            for p in rng.sample(range(len(own)), 3):
                own[p] = f"swap{p}"
        rows.append((k, sentence(2000 + k, 60) + " " + " ".join(own).upper() + "\n" + sentence(3000 + k, 60), None, None, None))
        truth.add((k, i))
    rows += [(100 + k, sentence(4000 + k, 300), None, None, None) for k in range(20)] + [(200, None, None, None, None), (201, "", None, None, None), (None, items[2][1], None, None, None)]
    truth |= {(None, 2)} | {(k, 93) for k, i in truth if i == 0}
    docs = clashing(documents(spark, rows))
    got = decontamination.benchmark_overlaps(docs, benchmark)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == truth
    blocks = decontamination.benchmark_overlaps(docs, benchmark, block_words=100)
    assert {(r["doc_id"], r["item_id"]) for r in blocks.collect()} == truth
    clean = decontamination.without_overlaps(docs, benchmark, block_words=100)
    assert {r["doc_id"] for r in clean.collect()} == set(range(100, 120)) | {200, 201} and clean.columns == docs.columns
    assert decontamination.benchmark_overlaps(docs.limit(0), benchmark).count() == 0
    assert decontamination.without_overlaps(docs, benchmark.limit(0)).count() == len(rows)


def counts(same):
    """Most equal words of any stretch of which four fifths are equal, by trying all."""
    return max([sum(same[i:j]) for i in range(len(same)) for j in range(i + 1, len(same) + 1) if 5 * sum(same[i:j]) >= 4 * (j - i)], default=0)


def test_seeds_hit_every_stretch_that_counts():
    masks = [int(m, 2) for m in decontamination.MASKS]
    for n in range(8, 16):
        needed = min(12, -(-4 * n // 5))
        for changed in itertools.chain.from_iterable(itertools.combinations(range(n), k) for k in range(n - needed + 1)):
            same = [i not in changed for i in range(n)]
            bits = sum(s << i for i, s in enumerate(reversed(same)))
            if counts(same) >= needed:
                assert any(bits >> k & m == m for m in masks for k in range(n - m.bit_length() + 1)), same
    # Longer stretches: the highest sum (1 for an equal word, -4 for another) of any that no mask hits, by its last words and its equal words.
    # A start below -16 needn't be followed: if the sum recovers, what comes after it counts by itself.
    wide = (1 << max(m.bit_length() for m in masks)) - 1
    best = todo = {(0, 0): 0}
    while todo:
        new = {}
        for ((last, equal), total), bit in itertools.product(todo.items(), (0, 1)):
            key, value = ((last << 1 | bit) & wide, min(equal + bit, 12)), total + (1 if bit else -4)
            if value >= -16 and not (bit and any(key[0] & m == m for m in masks)) and value > max(best.get(key, -99), new.get(key, -99)):
                assert key[1] < 12 or value < 0
                new[key] = value
        best, todo = best | new, new


def test_passages_changed_near_their_ends(spark):
    rng = np.random.default_rng(8)
    items, rows, expected = [], [], {}
    cases = [(12, [2]), (14, [1]), (15, [2]), (16, [2, 7, 11]), (8, [3]), (10, [3, 6])]
    cases += [(n, [e]) for n in range(8, 26) for e in (0, 1, 2, 3, n - 4, n - 3, n - 2, n - 1)]
    cases += [(n, rng.choice(n, int(rng.integers(1, n // 4 + 2)), replace=False).tolist()) for n in list(range(8, 26)) * 12]
    for k, (n, changed) in enumerate(cases):
        words = [f"w{k}x{i}" for i in range(n)]
        items.append((k, " ".join(words)))
        rows.append((k, " ".join([f"a{k}"] * 5 + [f"b{i}" if i in changed else w for i, w in enumerate(words)] + ["z"] * 5)))
        most = counts([i not in changed for i in range(n)])
        if most >= min(12, -(-4 * n // 5)):
            expected[k] = most
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.benchmark_overlaps(docs, benchmark).collect()
    assert {r["doc_id"]: r["n_same"] for r in got} == expected and all(r["doc_id"] == r["item_id"] and 5 * r["n_same"] >= 4 * r["n_words"] for r in got)
    clean = decontamination.without_overlaps(docs, benchmark)
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(cases))) - set(expected)


def test_short_items_and_odd_ids(spark):
    items = [("one", "lonely"), ("two", "quick marsh"), (None, "seven words stand here in a row"), ("r", "some words stand twice here as a whole item"), ("r", "some words stand twice here as a whole item"), ("r", "another text under the same id as those above"), ("none", " "), ("null", None)]
    docs = {
        1: "x LONELY y", 2: "quick\nmarsh", 3: "quick brown marsh", 4: "seven words stand here in a row", 5: "seven words stand HERE in the row", 6: "lonelyx",
        7: "some words stand twice here as a whole item", 8: "another text under the same id as those above", 9: "", 10: None,
    }
    got = decontamination.benchmark_overlaps(spark.createDataFrame(list(docs.items()), "doc_id int, text string"), spark.createDataFrame(items, "item_id string, text string"))
    assert sorted((r["doc_id"], str(r["item_id"]), r["n_words"]) for r in got.collect()) == [(1, "one", 1), (2, "two", 2), (4, "None", 7), (7, "r", 9), (8, "r", 9)]


def test_passages_of_all_lengths_against_all_alignments(spark):
    """Items of 1 to 100 words with up to a fifth of them substituted, each against every text by trying all alignments and stretches."""
    rng = random.Random(31)
    items, rows = [], []
    for k in range(150):
        n = rng.choice([1, 2, 4, 6, 7, 8, 9, 10, 12, 14, 15, 20, 30, 50, 100])
        words = [f"w{rng.randrange(400)}" for _ in range(n)]
        own = list(words)
        for p in rng.sample(range(n), rng.randint(0, -(-n // 5))):
            own[p] = f"s{p}"
        items.append((k, words))
        rows.append((k, [f"a{rng.randrange(400)}" for _ in range(rng.randrange(30))] + own + [f"w{rng.randrange(400)}" for _ in range(rng.randrange(30))]))
    expected = set()
    for k, words in items:
        n = len(words)
        needed = min(12, -(-4 * n // 5)) if n >= 8 else n
        for d, text in rows:
            if sum(w in text for w in words) >= needed:
                for shift in range(1 - n, len(text)):
                    same = [text[i] == words[i - shift] for i in range(max(shift, 0), min(shift + n, len(text)))]
                    if sum(same) >= needed and counts(same) >= needed:
                        expected.add((d, k))
                        break
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in rows], "doc_id long, text string")
    got = decontamination.benchmark_overlaps(docs, spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string"), block_words=700)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == expected and len(expected) > 150


def test_passages_of_the_documents(spark, sf_dir):
    words = lambda t: WORD.findall((t or "").lower())
    items = [(r[0], words(r[1])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    whole = set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        text = " " + " ".join(words(r[1])) + " "
        whole |= {(r[0], i) for i, w in items if " " + " ".join(w) + " " in text}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op8_decontamination"](spark, sf_dir).collect()}
    assert whole and whole <= got and len(got - whole) <= 0.05 * len(got)


# 10


def test_token_counts_at_every_prefix(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(VOCABULARY)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    texts = ["", "don't we'll they're I've", "  x\n\n y\t\tz  ", "a<|endoftext|>b  <|endoftext|>", "<|endoftext", "ñandú  日本語 😀 é́", "\n \n  \r\n", "a" * 200 + "  ÃÂÃÂ"]
    rng = random.Random(2)
    texts += ["".join(rng.choice(["a", "the", " ", "  ", "\n", "'", "ll", "1", "!", "é", "日", "<|endoftext|>"]) for _ in range(20)) for _ in range(60)]
    counter = tokens.counter(VOCABULARY)
    for t in texts:
        own = np.frombuffer(counter.text(t), np.int8).cumsum()
        assert own.tolist() == [count(t[:k]) for k in range(1, len(t) + 1)]


def test_token_table_of_odd_rows(spark):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(VOCABULARY)
    docs = clashing(documents(spark))
    out = tokens.prefix_tokens(docs, VOCABULARY).select("doc_id", "n_tokens", "n_chars", tokens.tokens_at("token_steps", F.lit(50)).alias("at"), tokens.longest_within("token_steps", F.lit(20)).alias("within")).collect()
    texts = {repr(r[0]) + repr(r[4]): r[1] or "" for r in odd_rows()}
    for r in out:
        t = texts[repr(r["doc_id"]) + repr(r["n_chars"])]
        count = lambda x: len(library.encode(x, add_special_tokens=False).ids)
        assert r["n_tokens"] == count(t) and r["at"] == count(t[:50])
        fits = [k for k in range(0, min(len(t), 400) + 1) if count(t[:k]) <= 20]
        assert r["within"] == max(fits)
    assert tokens.prefix_tokens(documents(spark, []), VOCABULARY).count() == 0


def test_other_kinds_of_vocabulary_are_refused(tmp_path):
    path = tmp_path / "other.json"
    path.write_text(json.dumps({"model": {"type": "WordPiece"}, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}}))
    with pytest.raises(ValueError):
        tokens.PrefixCounter(str(path))


def test_collected_texts_keep_their_bound(spark):
    from soundgrid.llm.common import collected_texts

    rows = spark.createDataFrame([(i, "x" * (i % 7 + 1)) for i in range(200)] + [(1000, "y" * 5000)], "doc_id int, text string")
    every = collected_texts(rows, "doc_id", "text", 10_000, 3)
    assert [r["doc_id"] for r in every] == [*range(200), 1000]
    some = collected_texts(rows.repartition(5), "doc_id", "text", 300, 3)
    size = sum(len(r["text"]) for r in some)
    assert 293 < size <= 300 and [r["doc_id"] for r in some] == sorted({r["doc_id"] for r in some}) and 1000 not in {r["doc_id"] for r in some}
    assert some == collected_texts(rows, "doc_id", "text", 300, 3)
    assert collected_texts(rows.limit(0), "doc_id", "text", 300, 3) == []
