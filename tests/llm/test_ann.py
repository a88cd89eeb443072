"""Nearest neighbours: recall, scores, ties and odd vectors."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from varloom.llm import ann
from varloom.llm.common import stage


def exact(ids, vectors, asked, k):
    s = vectors.astype(float) @ vectors.astype(float).T
    out = {}
    for q in asked:
        i = int(np.flatnonzero(ids == q)[0])
        others = np.flatnonzero(ids != q)
        best = others[np.lexsort((ids[others], -s[i, others]))][:k]
        out[q] = [(int(ids[b]), s[i, b]) for b in best]
    return out


def test_recall_on_the_given_table(spark):
    v = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    p = v.toPandas()
    ids, x = p.vec_id.to_numpy(), np.stack(p.embedding)
    want = exact(ids, x, [i for i in ids if i % 20 == 0], 20)
    got = ann.nearest(v, v.filter("vec_id % 20 = 0")).toPandas()
    hit = 0
    for q, best in want.items():
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21))
        assert mine.score.is_monotonic_decreasing
        hit += len({b for b, _ in best} & set(mine.vec_id))
    assert hit >= 0.9 * 20 * len(want)


@pytest.fixture
def odd(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(y)) for y in rng.normal(size=4) * (1 + i % 3)], 0, "x") for i in range(60)]
    rows += [(100 + i, [1.0, 0.0, 0.0, 2.0], 0, "x") for i in range(50)]  # equal vectors
    rows += [(200, None, 0, "x"), (220, [None, 1.0, 1.0, 1.0], 0, "x"), (240, [float("nan"), 1.0, 1.0, 1.0], 0, "x"),
             (260, [float("inf"), 1.0, 1.0, 1.0], 0, "x"), (280, [0.0, 0.0, 0.0, 0.0], 0, "x"), (300, [1.0, 2.0], 0, "x"), (320, [], 0, "x")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, list string")


def test_odd_vectors_and_ties(odd):
    p = odd.filter("vec_id < 200").toPandas()
    ids, x = p.vec_id.to_numpy(), np.stack(p.embedding)
    got = ann.nearest(odd, odd.filter("vec_id % 20 = 0"), 20).toPandas()
    want = exact(ids, x, [i for i in ids if i % 20 == 0], 20)
    assert set(got.query_id) == set(want)
    for q, best in want.items():  # so few vectors are all seen
        mine = got[got.query_id == q].sort_values("rank")
        assert mine.vec_id.tolist() == [b for b, _ in best]
        assert np.allclose(mine.score, [s for _, s in best])


def test_few_and_no_rows(odd):
    two = odd.filter("vec_id in (0, 20)")
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in ann.nearest(two, two).collect()) == [(0, 1, 20), (20, 1, 0)]
    assert ann.nearest(odd.filter(F.lit(False)), odd).collect() == []
    assert ann.nearest(odd, odd.filter(F.lit(False))).collect() == []


def test_repeated_rows_and_shared_ids(spark, odd):
    few = odd.filter("vec_id < 60").select("vec_id", "embedding")
    key = lambda df: sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())
    want = key(ann.nearest(few, few.filter("vec_id % 20 = 0"), 5))
    thrice = few.union(few).union(few.filter("vec_id < 30"))
    assert key(ann.nearest(thrice, thrice.filter("vec_id % 20 = 0"), 5)) == want
    # a second vector under the id 20 is a query and a candidate of its own
    other = few.union(spark.createDataFrame([(20, [9.0, 0.0, 0.0, 0.0])], few.schema))
    rows = ann.nearest(other, other.filter("vec_id = 20"), 70).collect()
    assert sorted(r["rank"] for r in rows) == sorted(list(range(1, 61)) * 2)
    assert sum(r.vec_id == 20 for r in rows) == 2


def test_recall_where_lists_are_pruned(spark, monkeypatch):
    """40,000 vectors around those of the given table: what is read, and how much of the truth is found."""
    base = np.stack(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas().embedding)
    rng = np.random.default_rng(2)
    x = (np.tile(base, (20, 1))[:40_000] + rng.normal(scale=0.2 * base.std(), size=(40_000, base.shape[1]))).astype(np.float32)
    ids = np.arange(len(x))
    table = pa.table({"vec_id": ids, "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))})
    v = spark.createDataFrame(table).repartition(8)
    staged = {}
    keep = lambda df, name: staged.setdefault(name, stage(df, name))
    monkeypatch.setattr(ann, "stage", keep)
    got = ann.nearest(v, v.filter("vec_id % 200 = 0")).toPandas()
    sizes = staged["ann-lists"].groupBy("list").agg(F.count("*").alias("n"))
    read = staged["ann-reads"].join(sizes, "list").agg(F.sum("n")).first()[0] / (200 * len(x))
    hit = sum(len(set(got[got.query_id == q].vec_id) & {b for b, _ in best}) for q, best in exact_some(x, ids[::200], 20).items())
    assert read < 0.3 and hit >= 0.9 * 20 * 200, (read, hit / 4000)


def exact_some(x, asked, k):
    s = x[asked].astype(float) @ x.astype(float).T
    s[np.arange(len(asked)), asked] = -np.inf
    return {int(q): [(int(b), s[i, b]) for b in np.argsort(-s[i], kind="stable")[:k]] for i, q in enumerate(asked)}


def test_number_of_lists():
    assert [ann.list_count(n) for n in (1, 64, 65, 10**6, 10**8, 10**12)] == [1, 1, 2, 2048, 10**4, 1 << 16]


def test_two_levels_cover_the_sample(monkeypatch):
    monkeypatch.setattr(ann, "FLAT", 16)
    x = np.random.default_rng(3).normal(size=(3000, 8)).astype(np.float32)
    c = ann.make_centroids(x, 150)
    assert 140 <= len(c.points) <= 175
    ids, dist = c.search(x[:100], 64)
    assert (ids[:, 0] == ann._nearest(x[:100], c.points)).mean() > 0.95
    assert np.bincount(ann._nearest(x, c.points), minlength=len(c.points)).max() < 6 * 3000 / 150


def test_long_lists_are_dealt_in_blocks(odd, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 5)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 2)
    few = odd.filter("vec_id < 200")
    key = lambda df: sorted((r.query_id, r["rank"], r.vec_id) for r in df.collect())
    got = key(ann.nearest(few, few.filter("vec_id % 20 = 0")))
    monkeypatch.undo()
    assert got == key(ann.nearest(few, few.filter("vec_id % 20 = 0")))
