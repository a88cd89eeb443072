"""Tables between the steps of an operator: computed once, two copies, no files."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from varloom.llm import common
from varloom.session import checkpoint_root

SF = "/root/testdata/sf0.001"


def _files(spark) -> set[str]:
    root = checkpoint_root(spark).removeprefix("file:")
    return {f"{d}/{x}" for d, _, names in os.walk(root) for x in names if x.endswith(".parquet")}


@pytest.mark.parametrize("step", ["line_dedup", "ngram_join", "pii", "packing"])
def test_steps_write_no_files(spark, step):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = _files(spark)
    assert dict(corpus_pipeline.STAGES)[step](spark, docs, SF).count() > 0
    assert _files(spark) == before


def test_held_tables_are_computed_once_in_two_copies(spark):
    wide = common.held(spark.range(0, 1000, 1, 100).withColumn("x", F.rand()))
    assert sorted(wide.collect()) == sorted(wide.collect())
    assert wide.count() == 1000 and wide.rdd.getNumPartitions() == max(2, spark.sparkContext.defaultParallelism, 100 // common.BLOCKS)
    levels = [r.getStorageLevel() for r in spark.sparkContext._jsc.getPersistentRDDs().values()]
    assert any(x.useDisk() and not x.useMemory() and x.replication() == 2 for x in levels)
    assert common.held(wide.filter("id < 0")).isEmpty()
