"""Token ids in raw shards: every row back through the index, as the library gives it."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from public_tokenizers import path
from tokenizers import Tokenizer

from varloom.llm import token_store as store
from varloom.session import work_dir

PATH = path("word_bpe_49k.json")


def expected(df):
    library = Tokenizer.from_file(PATH)
    rows = [(r.doc_id is not None, r.doc_id or 0, r.h, r.text) for r in
            df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text")).collect()]
    out, at, before, copy = [], 0, None, 0
    for known, doc_id, _, text in sorted(rows, key=lambda r: r[:3]):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        copy = copy + 1 if (known, doc_id) == before else 0
        before = (known, doc_id)
        out.append((doc_id if known else None, copy, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is not None, x or 0) for x in r])


def stored(spark, df, **kwargs):
    folder = work_dir(spark, "test-store")
    store.write_shards(df, PATH, folder, **kwargs)
    store.write_index(spark, folder)
    return folder


def read(spark, folder, df):
    out = store.fetch(spark, folder, store.keys_of(df))
    return [tuple(r) for r in out.select("doc_id", "copy", "start", "n_tokens", F.crc32("ids")).collect()]


@pytest.mark.parametrize("shard_bytes", [store.SHARD, 4000])
def test_every_document_comes_back(spark, docs, shard_bytes):
    folder = stored(spark, docs, shard_bytes=shard_bytes)
    assert ordered(read(spark, folder, docs)) == ordered(expected(docs))


def test_null_ids_shared_ids_and_repeated_rows_over_many_shards(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 7 ELSE id END AS doc_id",
                                      "CASE WHEN id % 4 = 0 THEN NULL WHEN id % 4 = 1 THEN 'same text' ELSE concat('t ', id % 10) END AS text", "id AS copy")
    folder = stored(spark, df, shard_bytes=600)
    assert spark.read.parquet(f"{folder}/list").count() > 5
    assert ordered(read(spark, folder, df)) == ordered(expected(df))


def test_shards_are_raw_and_in_order(spark, docs):
    folder = stored(spark, docs, shard_bytes=20_000)
    files = spark.read.parquet(f"{folder}/list").join(store._files(spark, folder), "file").orderBy("shard").collect()
    assert len(files) > 3
    ids, at = [], 0
    for f in files:
        shard = store.Shard(bytes(f["content"]))
        assert f["first_token"] == at and shard.width == 2 and len(shard.doc_ids) == f["docs"]
        ids += [None if i < shard.nulls else d for i, d in enumerate(shard.doc_ids.tolist())]
        at += int(shard.sizes.sum())
        assert len(shard.ids(0, int(shard.sizes.sum()))) == f["tokens"]
    assert ids == [r[0] for r in expected(docs)]


def test_unknown_keys_give_no_row_and_repeated_keys_one(spark, docs):
    folder = stored(spark, docs)
    unknown = spark.range(5000).selectExpr("id + 10000000 AS doc_id", "0L AS copy")
    one = store.keys_of(docs).filter("doc_id = 900010")
    assert store.fetch(spark, folder, unknown).count() == 0
    got = store.fetch(spark, folder, one.union(one).union(unknown)).collect()
    assert [(r.doc_id, r.n_tokens) for r in got] == [(r[0], r[3]) for r in expected(docs) if r[0] == 900010]


def test_empty_table(spark, empty):
    folder = stored(spark, empty)
    assert read(spark, folder, empty) == []


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 40_000])
def test_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    a, b = store.key_hashes(rng.permutation(10 * n)[:n] - n, np.zeros(n, bool), rng.integers(0, 3, n))
    seed, third, marks = store.peel(a, b)
    data = store.packed_marks(marks)
    assert sorted(store.slots_of(a, b, seed, third, data).tolist()) == list(range(n))
    assert len(data) <= 0.31 * n + 4


def test_null_and_zero_are_different_keys():
    a, b = store.key_hashes(np.zeros(2, np.int64), np.array([False, True]), np.zeros(2, np.int64))
    assert a[0] != a[1] or b[0] != b[1]
    with pytest.raises(ValueError):
        store.peel(np.repeat(a[:1], 2), np.repeat(b[:1], 2))
