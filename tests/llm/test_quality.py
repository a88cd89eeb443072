"""Quality classifier: held-out accuracy, odd rows, additive form."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from varloom.llm import quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = quality.classify(docs, labels).join(labels, "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(out.doc_id, out.held_out, strict=True))
    held = out[out.held_out]
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    auc = (good[:, None] > bad[None]).mean() + 0.5 * (good[:, None] == bad[None]).mean()
    assert auc > 0.97
    assert (held.predicted == held.quality).mean() > 0.93
    assert ((out.score >= 0.7) == (out.predicted == 1)).all()


def test_held_out_labels_are_not_learned(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, flipped)
    assert all((x == y).all() for x, y in zip(a.tables, b.tables, strict=True))


def test_odd_rows(docs, empty, spark, repeated):
    labels = spark.createDataFrame([(900005, 1, 0), (900007, 0, 0), (900007, None, None), (None, 1, 1), (3, 5, 0)], "doc_id long, quality int, toxic int")
    out = quality.classify(docs, labels)
    assert out.count() == docs.count()
    assert all(0 <= r.score <= 1 for r in out.collect())
    assert quality.classify(repeated, labels).count() == repeated.count()
    assert quality.classify(empty, labels).collect() == []
    none = quality.classify(docs.limit(5), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_pairs_learn_an_interaction():
    rng = np.random.default_rng(3)
    x = np.zeros((4000, len(quality.FEATURES)))
    x[:, 0], x[:, 1] = rng.random(4000), rng.random(4000)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert {model.pairs[0][0], model.pairs[0][1]} == {0, 1}
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.9


def test_features_of_whole_texts():
    assert (quality.features(b"") == 0).all()
    assert np.isfinite(quality.features(b"\n \n")).all()
    a, b = quality.features(b"word " * 5000), quality.features(b"word " * 5000 + b"!!!! " * 5000)
    assert b[quality.FEATURES.index("bang")] > a[quality.FEATURES.index("bang")]
