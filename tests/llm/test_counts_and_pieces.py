"""Token counts and sampled segmentations."""

import public_tokenizers
import sentencepiece
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from varloom.llm import piece_sampling, pretokens
from varloom.llm.hashing import mix
from varloom.llm.token_counts import Lengths, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_counts_equal_the_library(docs, texts, repeated):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = token_counts(docs, MODEL, limit=1000).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        k: (len(t.encode()), len(sp.encode(t)), len(sp.encode(t)) > 1000) for k, t in texts.items()}
    assert token_counts(repeated, MODEL).count() == repeated.count()


def test_counts_of_an_empty_table(empty):
    assert token_counts(empty, MODEL).collect() == []


def test_parts_of_long_texts(monkeypatch, texts):
    monkeypatch.setattr(pretokens, "CHUNK", 7)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    lengths = Lengths(MODEL, {})
    for t in [x for x in texts.values() if len(x) < 3000] + [" a", "a ", "  ", "▁", "a  b", "x" * 50]:
        assert sum(sum(map(lengths.__getitem__, p)) for p in pretokens.pretoken_chunks(t)) == len(sp.encode(t)), t


def test_sampled_pieces_decode_to_the_text(docs, texts, empty):
    voc = piece_sampling.vocabulary(MODEL, 1.0)
    rows = piece_sampling.sample_pieces(docs, MODEL, seed=3).collect()
    for r in rows:
        assert r.lossless and r.n_pieces == len(r.ids)
        assert piece_sampling.decode(r.ids, voc) == texts[r.doc_id].encode()
    assert len(rows) == len(texts)
    assert piece_sampling.sample_pieces(empty, MODEL).collect() == []


def test_samples_depend_on_row_and_seed_only(docs):
    few = docs.filter("doc_id < 60")
    crc = lambda df, seed: {r.doc_id: r.ids_crc32 for r in piece_sampling.sample_pieces(df, MODEL, seed, keep_ids=False).collect()}
    a = crc(few, 1)
    assert a == crc(few.repartition(5, F.rand(1)), 1)
    assert sum(a[k] != v for k, v in crc(few, 2).items()) > len(a) // 2


def test_samples_follow_the_path_weights():
    lattices = piece_sampling.Lattices(piece_sampling.vocabulary(MODEL, 1.0))
    n = 100_000
    ids, per = lattices.sample(np.repeat(lattices.numbers(["there"]), n), mix(np.arange(n, dtype=np.uint64)))
    ends = np.cumsum(per)
    seen = Counter(tuple(ids[e - p:e].tolist()) for e, p in zip(ends, per, strict=True))
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    pieces = {sp.id_to_piece(i): (i, 1 / (r + 1)) for r, i in enumerate(plain)}

    def paths(s):
        if not s:
            yield (), 1.0
        for j in range(1, len(s) + 1):
            if s[:j] in pieces:
                for rest, w in paths(s[j:]):
                    yield (pieces[s[:j]][0], *rest), w * pieces[s[:j]][1]

    weight = dict(paths("▁there"))
    total = sum(weight.values())
    assert set(seen) <= set(weight)
    assert max(abs(seen[k] / n - w / total) for k, w in weight.items()) < 0.01


def test_cache_forgets_only_the_latest(monkeypatch):
    monkeypatch.setattr(piece_sampling, "CACHE", 2)
    lattices = piece_sampling.Lattices(piece_sampling.vocabulary(MODEL, 1.0))
    words = ["a", "bb", "the", "and"]
    before = lattices.sample(lattices.numbers(words), mix(np.arange(4, dtype=np.uint64)))[0].tolist()
    lattices.trim()
    assert list(lattices.number) == ["a", "bb"]
    assert lattices.sample(lattices.numbers(words), mix(np.arange(4, dtype=np.uint64)))[0].tolist() == before


def test_substrings_that_begin_no_piece_are_dropped_at_once(monkeypatch):
    hashed = []
    monkeypatch.setattr(piece_sampling, "mix", lambda x: hashed.append(len(x)) or mix(x))
    lattices = piece_sampling.Lattices(piece_sampling.vocabulary(MODEL, 1.0))
    hashed.clear()
    words = ["xqzjk" * 20, "0f7c-9d31-" * 10, "wkvbn" * 20]
    lattices.numbers(words)
    assert sum(hashed) < 6 * sum(len(w) + 1 for w in words)


def test_arcs_and_shares_equal_all_pieces_that_end_there(monkeypatch):
    monkeypatch.setattr(piece_sampling, "CACHE", 3)
    voc = piece_sampling.vocabulary(MODEL, 1.0)
    lattices = piece_sampling.Lattices(voc)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    pieces = {sp.id_to_piece(i): (i, 1 / (r + 1)) for r, i in enumerate(plain)}
    words = ["there", "", "internationally", "  two", "▁x", "日本語", "a\U0010ffffb", "und", "xqzjk" * 5]
    for block in (words[:2], words[2:5], words[5:], words):  # built, forgotten and built anew
        for w, number in zip(block, lattices.numbers(block).tolist(), strict=True):
            units = ["▁"]
            for c in w:
                known = c in pieces and c != "▁"
                units += [c] if known else ["▁"] if c == " " else [bytes([b]) for b in c.encode()]
            before = [1.0]
            for end in range(1, len(units) + 1):
                arcs = [(end - at, *pieces["".join(units[at:end])]) for at in range(end)
                        if all(isinstance(u, str) for u in units[at:end]) and "".join(units[at:end]) in pieces]
                if isinstance(units[end - 1], bytes):
                    arcs = [(1, int(voc.byte_ids[units[end - 1][0]]), 1.0)]
                weight = np.array([before[end - back] * x for back, _, x in arcs])
                before.append(weight.sum())
                node = lattices.first.kept[number] + end - 1
                a, b = lattices.arc_first.kept[node], lattices.arc_first.kept[node + 1]
                assert list(zip(lattices.back.kept[a:b].tolist(), lattices.ids.kept[a:b].tolist(), strict=True)) == [x[:2] for x in arcs]
                assert np.allclose(lattices.share.kept[a:b - 1], (np.cumsum(weight) / weight.sum())[:-1], atol=1e-6)
            assert lattices.size.kept[number] == len(units)
        lattices.trim()
        assert len(lattices.number) <= 3
