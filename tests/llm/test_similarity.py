"""N-gram join and line dedup against plain Python."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from varloom.llm import line_dedup, ngram_join
from varloom.llm.common import components


def shingles(text: str) -> frozenset:
    w = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def linked(a, b) -> bool:
    i = len(a & b)
    return bool(a) and 100 * i >= 75 * (len(a) + len(b) - i)


def expected_components(sets: dict) -> dict:
    own = {k: k for k in sets}
    shared = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            shared[x].append(k)
    pairs = {(a, b) for ks in shared.values() for a in ks for b in ks if a < b}

    def find(x):
        while own[x] != x:
            x = own[x]
        return x

    for a, b in pairs:
        if linked(sets[a], sets[b]):
            x, y = find(a), find(b)
            own[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def check(docs, texts):
    rows = ngram_join.ngram_components(docs).collect()
    sets = {k: shingles(t) for k, t in texts.items()}
    assert {r.doc_id: r.n_shingles for r in rows} == {k: len(s) for k, s in sets.items()}
    assert {r.doc_id: r.component_id for r in rows} == expected_components(sets)
    return rows


def test_components(docs, texts):
    check(docs, texts)


def test_a_family_of_near_copies_takes_several_rounds(spark, monkeypatch):
    """A chain of texts that each resemble their neighbours only, and a family around one text."""
    monkeypatch.setattr(ngram_join, "OPEN", 0)
    words = [f"w{i}" for i in range(400)]
    texts = {i: " ".join(words[4 * i:4 * i + 120]) for i in range(60)}
    for i in range(40):
        base = [f"v{j}" for j in range(100)]
        base[7 * i % 100], base[(11 * i + 3) % 100] = f"x{i}", f"y{i}"
        texts[1000 + i] = " ".join(base)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    rows = check(df, texts)
    assert len({r.component_id for r in rows}) < 20


def test_repeated_and_no_rows(repeated, empty):
    rows = ngram_join.ngram_components(repeated).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in repeated.select("doc_id").collect())
    assert ngram_join.ngram_components(empty).collect() == []


def expected_removed(texts: dict) -> dict:
    lines = {(k, i): shingles(x) for k in sorted(texts) for i, x in enumerate(texts[k].split("\n"))}
    lines = {k: s for k, s in lines.items() if s}
    seen = defaultdict(list)
    out = {}
    for k in sorted(lines):
        s = lines[k]
        near = {j for x in s for j in seen[x]}
        out[k] = any(linked(lines[j], s) for j in near)
        for x in s:
            seen[x].append(k)
    return out


@pytest.mark.parametrize("open_", [8, 0])
def test_removed_lines(docs, texts, monkeypatch, open_):
    monkeypatch.setattr(line_dedup, "OPEN", open_)
    few = docs if open_ else docs.filter("doc_id % 3 = 0 or doc_id > 900000")
    kept = {r.doc_id for r in few.select("doc_id").collect()}
    rows = line_dedup.removed_lines(few).collect()
    assert {(r.doc_id, r.line_no): r.removed for r in rows} == expected_removed({k: t for k, t in texts.items() if k in kept})


def test_dedup_lines_keeps_columns(docs, texts, repeated, empty):
    gone = expected_removed(texts)
    out = line_dedup.dedup_lines(docs)
    assert [c for c in docs.columns if c not in ("text", "n_removed")] == [c for c in out.columns if c not in ("text", "n_lines", "n_removed")]
    for r in out.select("doc_id", "text", "n_lines", "n_removed").collect():
        lines = texts[r.doc_id].split("\n")
        assert r.n_lines == len(lines)
        assert r.text == "\n".join(x for i, x in enumerate(lines) if not gone.get((r.doc_id, i)))
    assert line_dedup.dedup_lines(repeated).count() == repeated.count()
    assert line_dedup.dedup_lines(empty).collect() == []


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, j) for j in range(6, 40)] + [(7, 7)]
    df = spark.createDataFrame([(max(e), min(e)) for e in edges], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {i: 100 for i in range(101, 141)} | {j: 5 for j in range(6, 40)}
    assert components(df.filter(F.lit(False))).collect() == []
