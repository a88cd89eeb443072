"""Packing against the tokenizer library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from varloom.llm import packing
from varloom.llm.word_ids import id_bytes

PATH = public_tokenizers.path("word_bpe_49k.json")


def padding(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    lost = total = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        total += at
        lost += 0 if at & (at - 1) == 0 else capacity - at
    return lost / max(total, 1)


def check(rows, texts, capacity):
    library = Tokenizer.from_file(PATH)
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == set(texts)
    for k, text in texts.items():
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted(by_doc[k], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start:at].tobytes())
        assert at == len(ids)
    return padding(rows, capacity)


def test_pieces(docs, texts):
    assert check(packing.pack(docs, PATH).collect(), texts, 4096) < 0.02


def test_small_sequences(docs, texts):
    few = docs.filter("doc_id >= 900000")
    assert check(packing.pack(few, PATH, capacity=64).collect(), {k: t for k, t in texts.items() if k >= 900000}, 64) < 0.05


def test_repeated_and_no_rows(repeated, empty):
    rows = packing.pack(repeated, PATH).collect()
    padding(rows, 4096)
    assert sum(r.start == 0 for r in rows) == repeated.count()
    assert packing.pack(empty, PATH).collect() == []


def test_ids_in_parts(monkeypatch, texts):
    from varloom.llm import word_ids

    monkeypatch.setattr(word_ids, "CHUNK", 50)
    library = Tokenizer.from_file(PATH)
    for text in [t for t in texts.values() if len(t) < 5000]:
        assert b"".join(id_bytes(text, PATH)) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_plan_places_every_document_once():
    rng = np.random.default_rng(2)
    for lengths in (rng.integers(1, 200, 3000), np.full(500, 150), np.array([7]), rng.choice([3, 90, 127], 1000)):
        counts = np.bincount(lengths, minlength=256)
        plan = packing.make_plan(counts, 256)
        ordered = np.sort(lengths)
        out = packing._place(plan, 256, {"rest": ordered, "rank": np.arange(len(ordered))})
        covered = np.zeros(len(ordered), int)
        fill = defaultdict(int)
        for row, _, length, sequence, _ in out:
            np.add.at(covered, row, length)
            for s, n in zip(sequence.tolist(), length.tolist(), strict=True):
                fill[s] += n
        assert (covered == ordered).all()
        assert max(fill.values()) <= 256


def test_column_generation_reaches_the_bound():
    # 3 + 3 + 4 and 5 + 5 fill a sequence of ten: 20 of each class need (60 + 80 + 100) / 10 sequences or a little more
    solution = packing.column_generation(np.array([3, 4, 5]), np.array([40.0, 20.0, 40.0]), 10)
    assert abs(sum(x for _, x in solution) - 40) <= 40 * packing.GAP
