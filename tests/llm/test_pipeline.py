"""The pipeline, its stages and the registered queries."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opinionmill.llm import secrets
from opinionmill.llm.queries import ORACLES, QUERIES
from opinionmill.session import materialized
from tests.llm import brute


def test_every_operator_is_registered():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES] == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_stages_against_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    clean = materialized(spark, steps["toxicity"](spark, docs, sf_dir), "clean")
    assert clean.columns == names and clean.exceptAll(docs).count() == 0

    single = materialized(spark, steps["near_dedup"](spark, clean, sf_dir), "single")
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    linked = brute.near_components(texts.items(), 5)
    assert single.columns == names
    assert {r["doc_id"] for r in single.collect()} == {i for i, c in linked.items() if i == c}

    cut = materialized(spark, steps["suffix_dedup"](spark, single, sf_dir), "cut")
    want = brute.without_repeats((r["doc_id"], r["text"]) for r in single.collect())
    assert cut.columns == names
    for r in cut.collect():
        assert r["text"] == want[r["doc_id"]][4].decode("utf-8", "ignore") and r["n_chars"] == len(r["text"])

    safe = materialized(spark, steps["secrets"](spark, cut, sf_dir), "safe")
    assert safe.columns == names and safe.count() == cut.count()
    left = safe.select(secrets.base_spans(F.col("text")).alias("b")).where(F.size("b") > 0).count()
    assert left == 0
    before = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert all(r["text"] == before[r["doc_id"]] for r in safe.collect() if "[SECRET]" not in r["text"])

    packed = steps["packing"](spark, safe, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in safe.collect()}


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_over_odd_and_empty_tables(spark, odd, none, labels, stage, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    function = dict(corpus_pipeline.STAGES)[stage]
    result = function(spark, odd, str(tmp_path))
    if stage != "packing":
        assert result.columns == odd.columns
    assert 0 < result.count() <= odd.count() + 20
    assert function(spark, none, str(tmp_path)).count() == 0


def test_two_runs_before_the_first_is_read(spark, sf_dir):
    first = corpus_pipeline.run(spark, sf_dir)
    second = corpus_pipeline.run(spark, sf_dir)
    read = [sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in x.collect()) for x in (first, second)]
    assert read[0] and read[0] == read[1]
    assert {"doc_id", "sequence_id", "offset"} <= set(first.columns)
