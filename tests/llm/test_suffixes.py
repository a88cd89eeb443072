"""Induced suffix sorting and substring dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest

from varloom.llm import suffix_dedup
from varloom.llm.induced import suffix_array


@pytest.mark.parametrize("memory", [0, 64, 1 << 20])
def test_suffix_arrays(memory):
    rng = random.Random(memory)
    for _ in range(150):
        k = rng.choice([1, 2, 3, 5, 200])
        x = [rng.randrange(1, k + 1) for _ in range(rng.randrange(0, 60))] + [0]
        want = sorted(range(len(x)), key=lambda i: x[i:])
        for symbols in (k + 1, 600):
            assert suffix_array(np.array(x, np.uint16), symbols, memory).tolist() == want


def expected(texts: dict) -> dict:
    seen, out = set(), {}
    for k in sorted(texts):
        b = texts[k].encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            s = b[i:i + 100]
            if s in seen:
                gone[i:i + 100] = b"\1" * 100
            else:
                seen.add(s)
        runs = sum(bool(gone[i]) and (i == 0 or not gone[i - 1]) for i in range(len(b)))
        out[k] = (len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, y in zip(b, gone, strict=True) if not y)).hexdigest())
    return out


def rows_of(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.drop("kept").collect()}


def test_dedup(docs, texts):
    assert rows_of(suffix_dedup.dedup_substrings(docs)) == expected(texts)


def test_many_small_shards_and_blocks(docs, texts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD", 1000)
    few = docs.filter("doc_id % 4 = 0 or doc_id >= 900020")
    ids = {r.doc_id for r in few.select("doc_id").collect()}
    assert rows_of(suffix_dedup.dedup_substrings(few)) == expected({k: texts[k] for k in ids})


def test_an_anchor_beyond_the_bound_is_never_held(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    phrase = "a phrase that every document of this table holds at some place"
    tails = [" ".join(word() for _ in range(12)) for _ in range(4)]
    texts = {i: f"{' '.join(word() for _ in range(i % 20))} {phrase} {rng.choice(tails) if i % 2 else ' '.join(word() for _ in range(15))}"
             for i in range(80)}
    texts[80] = texts[7] + " " + texts[9]
    plain = suffix_dedup.trimmed

    def bounded(group, length):
        assert len(group) <= 8, len(group)
        return plain(group, length)

    monkeypatch.setattr(suffix_dedup, "trimmed", bounded)
    monkeypatch.setattr(suffix_dedup, "HOT", 8, raising=False)
    docs = spark.createDataFrame([*texts.items(), (7, texts[7])], "doc_id long, text string").repartition(4)
    want = expected(texts)
    assert sum(r[1] for r in want.values()) > 2000
    assert rows_of(suffix_dedup.dedup_substrings(docs)) == want


def test_repeated_and_no_rows(repeated, texts, empty):
    out = suffix_dedup.dedup_substrings(repeated)
    assert out.count() == repeated.count()
    ids = {r.doc_id for r in repeated.select("doc_id").collect()}
    assert rows_of(out) == expected({k: texts[k] for k in ids})
    assert suffix_dedup.dedup_substrings(empty).collect() == []


def test_anchors_depend_on_the_string_alone():
    rng = random.Random(4)
    s = bytes(rng.choice(b"abc ") for _ in range(100))
    h, p = suffix_dedup.anchors(s)
    assert len(h) == 1
    longer = b"zz" * 40 + s + b"qq" * 90
    h2, p2 = suffix_dedup.anchors(longer)
    assert (h[0], p[0] + 80) in set(zip(h2.tolist(), p2.tolist(), strict=True))
    assert len(suffix_dedup.anchors(b"a" * 99)[0]) == 0
    long = bytes(rng.choice(b"abcdefgh ") for _ in range(3 * suffix_dedup.BLOCK))
    h, p = suffix_dedup.anchors(long)
    assert (np.diff(p) > 0).all() and np.diff(p).max() <= 73
