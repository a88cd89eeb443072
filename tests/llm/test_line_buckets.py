"""Line dedup's packed buckets, its hashes of words by eight bytes, and its parity bits, against plain forms."""

import random
import re
from collections import defaultdict
from functools import reduce
from operator import xor

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.llm import line_dedup
from varloom.llm.hashing import LONG, block_words, words
from varloom.llm.prefix_sets import bits_agree, counted_tokens

I64, U = np.int64, np.uint64


def test_words_by_eight_bytes_are_the_same_words(texts):
    data = "\n".join(texts.values()) + " " + " ".join("ab" * n + x for n in range(40) for x in ("", "c", "C", "d"))
    data = (data + " " + "x" * (LONG + 1) + " " + "X" * (LONG + 1) + " " + "x" * LONG + " " + "x" * (LONG + 2)).encode()
    old, new = words(data), block_words(data)
    assert (old[1] == new[1]).all()
    assert len(set(zip(*(x[0].tolist() for x in (old, new)), strict=True))) == len(set(old[0].tolist())) == len(set(new[0].tolist()))
    text = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", data)]
    assert len(set(zip(text, new[0].tolist(), strict=True))) == len(set(text))
    for data in (b"", b" ", b"\n\n", b"a"):
        assert block_words(data)[1].tolist() == words(data)[1].tolist()


@pytest.mark.parametrize("ranked", [False, True])
@pytest.mark.parametrize("low_bits", [False, True])  # tokens that differ in their last bits only
def test_sorted_sets(ranked, low_bits):
    rng = np.random.default_rng(3)
    token = rng.integers(0, 1 << 63, 300).astype(U) * U(2) if not low_bits else U(1 << 60) + np.arange(300, dtype=U)
    token, line = token[rng.integers(0, 300, 5000)], rng.integers(0, 70, 5000)
    rank = (token % U(7)).astype(I64) * (token % U(2)).astype(I64) if ranked else None
    got = line_dedup._sorted_sets(line, token, rank)
    want = sorted({(x, 0 if rank is None else int(r), int(t)) for x, r, t in zip(line.tolist(), token if rank is None else rank, token, strict=True)})
    assert list(zip(got[0].tolist(), got[1].tolist(), strict=True)) == [(x, t) for x, _, t in want]
    assert got[2].tolist() == [i for i, w in enumerate(want) if not i or want[i - 1][0] != w[0]]


@pytest.mark.parametrize("held", [1 << 21, 64])  # the whole bucket at once, or reduced often and with tokens that are not held
def test_postings_and_sets_of_a_bucket(monkeypatch, held):
    monkeypatch.setattr(line_dedup, "HELD", held)
    rng = random.Random(11)
    rows = [(rng.choice([1, 2, 3, *range(10, 900)]), rng.randrange(60), 7 << 32 | 2) for _ in range(1500)]
    keys = defaultdict(set)
    for t, k, _ in rows:
        keys[t].add(k)
    work, out = line_dedup._Postings(), []
    for i in range(0, len(rows), 37):
        out += work.add(np.array(rows[i:i + 37], I64).T)
    out += work.end()
    got = [(r["kind"], r["token"], r["key"]) for b in out for r in b.to_pylist() if (r["n"], r["pos"]) == (7, 2)]
    assert {x[1:] for x in got} == {(t, k) for t, ks in keys.items() if len(ks) > 1 for k in ks}
    assert any(x[0] == line_dedup.HOT_POSTING for x in got) == (held == 64)
    held_ones = [x[1:] for x in got if x[0] == line_dedup.POSTING]
    assert len(held_ones) == len(set(held_ones)) and not {t for t, _ in held_ones} & {x[1] for x in got if x[0] == line_dedup.HOT_POSTING}

    lines = [(rng.randrange(20), 0, 9, rng.randrange(50), rng.randrange(4), 5) for _ in range(700)]
    first, place = {}, {}
    for a, b, n, doc, line, _ in lines:
        place.setdefault((doc, line), a)
    lines = [x for x in lines if place[x[3:5]] == x[0]]  # a line has one set
    for x in lines:
        first[x[0]] = min(first.get(x[0], x[3:5]), x[3:5])
    work, out = line_dedup._Sets(), []
    for i in range(0, len(lines), 29):
        out += work.add(np.array(lines[i:i + 29], I64).T)
    out += work.end()
    rows = [r for b in out for r in b.to_pylist()]
    assert {r["key"]: (r["doc"], r["line"]) for r in rows if r["kind"] == line_dedup.SET} == first
    assert {(r["doc"], r["line"]) for r in rows if r["kind"] == line_dedup.GONE} == {x[3:5] for x in lines} - set(first.values())


def test_parity_bits_lose_no_pair(spark):
    rng, rows = random.Random(2), []
    for i in range(400):
        n = rng.randrange(3, 60)
        x = {rng.getrandbits(64) for _ in range(n)}
        y = set(rng.sample(sorted(x), n - rng.randrange(0, n // 3 + 1))) | {rng.getrandbits(64) for _ in range(rng.randrange(0, n // 3 + 1))}
        bits = [reduce(xor, (1 << (t >> 58) for t in s)) for s in (x, y)]
        rows.append((*(b - (1 << 64) if b >> 63 else b for b in bits), len(x), len(y), 100 * len(x & y) >= 75 * len(x | y)))
    df = spark.createDataFrame(rows, "bx long, by long, nx long, ny long, linked boolean")
    got = df.groupBy("linked", bits_agree(*map(F.col, ("bx", "by", "nx", "ny"))).alias("kept")).count().collect()
    count = {(r.linked, r.kept): r["count"] for r in got}
    assert count[True, True] > 100 and (True, False) not in count and count[False, False] > 0


def test_rows_are_shuffled_by_bucket(spark, docs):
    """Prefixes go through the shuffle as one row for a bucket and task, not as a row for every token."""
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).repartition(2)
    table, total = counted_tokens(own, lambda batches: (line_dedup.line_tokens(d)[1] for _, _, d in line_dedup.Blocks(batches)))
    packed = line_dedup._rows(own, table, 64)
    assert total > 20_000 and packed.count() <= 2 * 64 * 2


@pytest.mark.parametrize("few", [1 << 20, -1])
def test_texts_stay_where_they_are_while_few_documents_lose_lines(spark, docs, monkeypatch, few):
    monkeypatch.setattr(line_dedup, "FEW", few)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = line_dedup.dedup_lines(docs.filter("doc_id < 50 or doc_id between 900020 and 900023"))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("BroadcastHashJoin" in plan) == (few > 0)
    kept = {r.doc_id: r.text for r in out.collect()}
    assert kept[900021] == "" and kept[900022] == "x" and kept[900023] == "short\n"


def test_postings_that_come_again_change_nothing(spark, docs, monkeypatch):
    """As if every second token had too many sets to be held by its task."""
    few = docs.filter("doc_id % 5 = 0 or doc_id between 900020 and 900032").select("doc_id", "text")
    rows = lambda: sorted(map(str, line_dedup.removed_lines(few).collect()))
    want, settled = rows(), line_dedup._settled

    def hot(packed):
        out = settled(packed)
        again = (F.col("kind") == line_dedup.POSTING) & (F.col("token") % 2 == 0)
        named = out.filter(again).withColumn("kind", F.lit(line_dedup.HOT_POSTING))
        return out.filter(~again).union(named).union(named)

    monkeypatch.setattr(line_dedup, "_settled", hot)
    assert rows() == want
