"""The pipeline's stages, each on what its predecessor kept."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from varloom.llm.common import stage

from test_native import base
from test_packing import check
from test_similarity import expected_components, expected_removed, shingles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("own")).withColumn("spans", F.lit(1))
    out = [docs]
    for name, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], SF), f"test-{name}"))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_stay(results):
    for df in results[1:-1]:
        assert df.columns == results[0].columns
        for r in df.collect():
            assert r.n_chars == len(r.text) and r.score == "own" and r.spans == 1


def test_quality_drops_few_good_documents(spark, results):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").toPandas()
    kept = set(rows(results[1]))
    good, bad = set(labels[labels.quality == 1].doc_id), set(labels[labels.quality == 0].doc_id)
    assert len(good & kept) >= 0.95 * len(good)
    assert len(bad & kept) <= 0.3 * len(bad)


def test_lines(results):
    before, after = {k: r.text for k, r in rows(results[1]).items()}, rows(results[2])
    gone = expected_removed(before)
    for k, text in before.items():
        want = "\n".join(x for i, x in enumerate(text.split("\n")) if not gone.get((k, i)))
        if k in after:
            assert after[k].text == want
        else:
            assert not want.split() and any(gone.get((k, i)) for i in range(len(text)))


def test_one_of_each_group_stays(results):
    before = {k: shingles(r.text) for k, r in rows(results[2]).items()}
    assert set(rows(results[3])) == {k for k, c in expected_components(before).items() if k == c}


def test_personal_data_is_masked(results):
    for k, r in rows(results[3]).items():
        new = rows(results[4])[k].text if base(r.text) else None
        if new is not None:
            assert not [x for x in base(new) if not x.startswith("card")]
            assert new != r.text


def test_packing(results):
    texts = {k: r.text for k, r in rows(results[4]).items()}
    assert check(results[5].collect(), texts, 4096) < 0.02
    assert public_tokenizers.path("word_bpe_49k.json")


def test_stages_take_no_rows_and_null_texts(spark, results):
    docs = results[0].filter("doc_id < 8").withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.col("text")))
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, results[0].limit(0), SF).collect() == [], name
        assert function(spark, docs.union(docs), SF).count() >= 0
