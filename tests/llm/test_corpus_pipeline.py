"""The pipeline against its operators applied by hand, and on odd rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from soundgrid.llm import decontamination, toxicity
from soundgrid.llm.common import written
from tests.llm.test_corpus_operators import SCHEMA, WORD, brute_components, brute_groups, brute_left, odd_rows, repeated_ids


def test_stages_on_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    state = docs
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, state, sf_dir), name)
        before, after = {r["doc_id"]: r["text"] for r in state.collect()}, out.collect()
        ids = [r["doc_id"] for r in after]
        if name != "sharding":
            assert out.columns == columns
        if name == "toxicity":
            assert sorted(ids) == sorted(i for i, t in before.items() if model.scores([t])[0] < 0.5)
        elif name == "near_duplicates":
            rows = [(i, t) for i, t in before.items()]
            assert sorted(ids) == sorted({int(g) for _, _, g in brute_groups(rows)})
        elif name == "decontamination":
            hit = {r["doc_id"] for r in decontamination.benchmark_overlaps(state, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
            assert hit and sorted(ids) == sorted(set(before) - hit)
        elif name == "mixing":
            assert set(ids) == set(before) and len(ids) > len(before) and max(ids.count(i) for i in set(ids)) == 2
        else:
            counts = [sum(r["shard"] == s for r in after) for s in range(16)]
            assert sum(counts) == state.count() and max(counts) - min(counts) <= 1
        state = out
    assert corpus_pipeline.run(spark, sf_dir).count() == state.count()


@pytest.mark.parametrize("rows", [[], odd_rows(), repeated_ids()])
def test_stages_on_odd_rows(spark, sf_dir, rows):
    """With clashing columns, against brute force: no group of texts is lost, no copy is kept, and rows repeat as rows."""
    docs = spark.createDataFrame(rows, SCHEMA)
    for c in ("toxicity_score", "record", "row", "taken", "node", "label"):
        docs = docs.withColumn(c, F.lit("extra"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = written(stage(spark, docs, sf_dir), name)
        after = docs.collect()
        if name != "sharding":
            assert docs.columns == columns and all(r["toxicity_score"] == r["record"] == r["label"] == "extra" for r in after)
        if name in ("toxicity", "decontamination"):  # nothing toxic or of the benchmark here
            assert sorted(map(repr, after)) == sorted(map(repr, before))
        elif name == "near_duplicates":
            seen = {(repr(r[0]), r[1]): g if own else -1 for r, own, g in zip(before, *brute_components(before))}
            assert sorted((repr(r["doc_id"]), seen[repr(r["doc_id"]), r["text"]]) for r in after) == brute_left(before)
        elif name == "mixing":
            times = Counter(map(repr, after)) - Counter(map(repr, before))
            assert not Counter(map(repr, before)) - Counter(map(repr, after)) and all(len(WORD.findall(r["text"] or "")) for r in after if repr(r) in times)
            assert all(n <= sum(repr(r) == k for r in before) for k, n in times.items())
        else:
            assert sorted(repr((r["doc_id"], r["text"])) for r in after) == sorted(repr((r["doc_id"], r["text"])) for r in before)


def test_mixing_knows_rows_apart_whose_values_stand_in_other_columns(spark, sf_dir):
    """Nulls that move between columns, maps, parts of structs and times: every row comes out as often as its own words say."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, tags map<string, string>, more struct<a: string, b: string>, seen timestamp"
    rows = [
        (1, "a b c", None, "web", 5, {"k": "v"}, ("x", None), None),
        (1, "a b c", "web", None, 5, {"k": "v"}, ("x", None), None),
        (1, "a b c", None, "web", 5, {"k": "v"}, (None, "x"), None),
        (1, "a b c", None, "web", 5, {"k": None}, ("x", None), None),
        (1, "a b c", None, "web", 5, None, ("x", None), None),
        (1, "a b c", None, "web", 5, {"k": "v"}, None, None),
        (None, "a b c", None, "web", 5, {}, None, None),
        (2, "d e", "en", "web", 1, {"k": "v"}, ("x", "y"), None),
        (2, "d e", "en", "web", 1, {"k": "v"}, ("x", "y"), None),
    ]
    docs = spark.createDataFrame(rows, schema)
    times = [f"2020-01-01 00:00:00.00000{i}" for i in (1, 2)]
    timed = docs.filter("doc_id = 2").limit(1).drop("seen").crossJoin(spark.createDataFrame([(t,) for t in times], "t string"))
    docs = written(docs.unionByName(timed.withColumn("seen", F.col("t").cast("timestamp")).drop("t")), "odd")
    before = Counter(map(repr, docs.collect()))
    after = Counter(map(repr, corpus_pipeline.mix_sources(spark, docs, sf_dir).collect()))
    assert set(after) == set(before) and all(before[k] <= after[k] <= 2 * before[k] for k in before) and sum(after.values()) > sum(before.values())
    keys = docs.select(corpus_pipeline.row_key(docs).alias("k")).distinct().count()
    assert keys == len(before)
    sharded = corpus_pipeline.shard(spark, docs, sf_dir)
    assert Counter(map(repr, sharded.select(*docs.columns).collect())) == before
