"""Null ids, one id with several texts, repeated rows: every operator gives every row back and mixes no two texts up."""

import hashlib
import re

import pytest
from public_tokenizers import path
from pyspark.sql import Row
from pyspark.sql import functions as F

from varloom.llm import imatch, line_dedup, ngram_join, packing, pii, piece_sampling, quality, suffix_dedup, token_counts
from varloom.llm.common import row_keys

LONG = " ".join(f"word{i}" for i in range(80))
ROWS = [(None, LONG), (None, "a completely different text, the very same id"), (None, None), (1, LONG + " end"), (1, "mail a.b@c.de is known to the host id77x1 here"),
        (2, "one two three four five six\nunique line of its own"), (2, "one two three four five six\nanother line of its own"), (3, "x"), (3, "x"), (4, "")]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in ROWS], "doc_id long, text string")
    for c in ("__key", "key", "n", "h", "spans", "component", "part"):
        df = df.withColumn(c, F.lit(c))
    return df.repartition(3)


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=lambda i: (i is not None, i or 0))


WANT = sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i or 0))


def test_keys_are_unique_and_in_order(spark, odd):
    keyed, names = row_keys(odd)
    back = {r["__key"]: r["__id"] for r in names.collect()}
    got = [(r["doc_id"], r["text"]) for r in keyed.collect()]
    assert sorted((back[k] is not None, back[k] or 0, t or "") for k, t in got) == sorted((i is not None, i or 0, t or "") for i, t in ROWS)
    assert len({(k, t or "") for k, t in got}) == len({k for k, _ in got}) == len({(i, t or "") for i, t in ROWS})
    order = [back[k] for k in sorted(back)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    alone = odd.filter("doc_id = 4")
    assert row_keys(alone)[1] is None


def test_counts_pieces_and_packing(odd):
    model = path("piece_bpe_32k.model")
    assert ids(token_counts.token_counts(odd, model).collect()) == WANT
    assert ids(piece_sampling.sample_pieces(odd, model).collect()) == WANT
    pieces = packing.pack(odd, path("word_bpe_49k.json"), capacity=64).collect()
    assert ids([p for p in pieces if p["start"] == 0]) == WANT


def test_links_and_lines(odd):
    found = ngram_join.ngram_components(odd).collect()
    assert ids(found) == WANT
    assert sorted((r["doc_id"], r["n_shingles"]) for r in found if r["component_id"] is None and r["doc_id"] is not None) == [(1, 77)]
    out = line_dedup.dedup_lines(odd).collect()
    assert ids(out) == WANT
    assert all("of its own" in r["text"] for r in out if r["doc_id"] == 2)
    assert sum("one two three" in r["text"] for r in out if r["doc_id"] == 2) == 1


def test_repeated_strings_stay_with_their_text(odd):
    out = suffix_dedup.dedup_substrings(odd).collect()
    assert ids(out) == WANT
    cut = [(r["doc_id"], r["n_removed"]) for r in out if r["n_removed"]]
    assert cut == [(1, len(LONG))]


def test_fingerprints_give_every_document(odd):
    out = imatch.fingerprints(odd).collect()
    distinct = sorted({(i, t or "") for i, t in ROWS}, key=lambda x: (x[0] is not None, x[0] or 0))
    assert ids(out) == [i for i, _ in distinct]
    assert all(re.fullmatch(r"[0-9a-f]{64}", r["edited_sha256"]) for r in out)


def test_masking_changes_only_its_own_text(odd):
    texts = {t or "" for _, t in ROWS}
    masked = pii.mask(odd).collect()
    assert ids(masked) == WANT and {r["text"] for r in masked} - texts == {"mail [EMAIL] is known to the host id77x1 here"}
    spans = pii.personal_data(odd).collect()
    assert ids(spans) == WANT
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(r["n_email"] for r in spans) == [0] * 9 + [1] and sum(r["base_sha256"] == empty for r in spans) == 9


def test_quality_scores_every_row(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(5)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    assert ids(quality.classify(odd, labels, 0.7).collect()) == WANT
