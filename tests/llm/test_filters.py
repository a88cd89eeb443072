"""Bloom filters of the right size, and the joins that do their work where there are too many keys."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.llm import common, line_dedup, ngram_join, packing, suffix_dedup
from varloom.llm.queries import tokenizer


@pytest.mark.parametrize("rows", [0, 1, 50_000, 400_000])
def test_filters_do_not_fill_up(spark, rows):
    bits = common.bloom(spark.range(rows)).value
    assert 8 * len(bits) >= max(common.LEAST_BITS, rows * common.KEY_BITS)
    assert common.bloom_hits(bits, np.arange(rows)).all()
    assert common.bloom_hits(bits, np.arange(10**9, 10**9 + 100_000)).mean() < 0.02


def test_too_many_keys_take_a_join(spark, monkeypatch):
    monkeypatch.setattr(common, "MOST_BITS", 160)
    assert common.bloom(spark.range(11)) is None and common.bloom(spark.range(10)) is not None
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    assert common.only_ids(docs, spark.range(7, 30).toDF("node")).count() == 23


@pytest.mark.parametrize("make", [ngram_join.ngram_components, line_dedup.dedup_lines, suffix_dedup.dedup_substrings,
                                  lambda docs: packing.pack(docs, tokenizer("word_bpe_49k.json"))])
def test_same_results_without_filters(docs, monkeypatch, make):
    own = docs.filter("doc_id <> 900051").select("doc_id", "text")
    rows = lambda: sorted(map(str, make(own).collect()))
    want = rows()
    monkeypatch.setattr(common, "MOST_BITS", -1)
    assert rows() == want
