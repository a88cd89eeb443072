"""Token counts: a map-side two-tier lookup of pre-token lengths.

Tier 1 is a compact table (pre-token -> number of tokens) of frequent
pre-tokens, broadcast to all tasks; its size is bounded by ``table_size``
entries. Tier 2 is each worker's cache: a pre-token outside the table is
encoded once per worker (bounded, kept across tasks) and looked up from
then on. No pre-token is shuffled: the frequent ones are found by a first
pass in which every task keeps a bounded Misra-Gries summary of its whole
input; only those summaries (one row per task) move and are merged.

Counts equal the library's for the whole text because no piece of the model
crosses a pre-token boundary (see ``pretokens``).

Edge cases: a null text counts as empty (0 bytes, 0 tokens); a text of any
length is split in bounded parts; repeated rows give a row each; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import id_text
from varloom.llm.pretokens import MARK, pretoken_chunks

TABLE = 1 << 16      # entries of the broadcast table
SUMMARY = 1 << 13    # counters a task hands on
CACHE = 1 << 19      # entries of a worker's cache
LONGEST = 64         # characters of a cached pre-token


class Summary:
    """Misra-Gries summary of strings: bounded, mergeable."""

    def __init__(self, size: int):
        self.size, self.counts = size, Counter()

    def trim(self, room: int = 1) -> None:
        if len(self.counts) > self.size * room:
            least = sorted(self.counts.values(), reverse=True)[self.size]
            self.counts = Counter({k: v - least for k, v in self.counts.items() if v > least})

    def add(self, words) -> None:
        self.counts.update(words)
        self.trim(16)

    def packed(self) -> str:
        self.trim()
        return json.dumps(self.counts, ensure_ascii=True)


def _merged(size: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Summary(size)
        for batch in batches:
            for row in batch.column(0).to_pylist():
                total.add(json.loads(row))
        if total.counts:
            yield pa.RecordBatch.from_arrays([pa.array([total.packed()])], ["summary"])
    return merge


def frequent_pretokens(docs: DataFrame, size: int = TABLE, per_task: int = SUMMARY) -> list[str]:
    """The commonest pre-tokens of all documents, at most ``size``; every task reads its whole input."""

    def scan(batches):
        top = Summary(per_task)
        for batch in batches:
            for text in batch.column(0):
                for words in pretoken_chunks(text.as_py()):
                    top.add(words)
        if top.counts:
            yield pa.RecordBatch.from_arrays([pa.array([top.packed()])], ["summary"])

    rows = docs.select("text").mapInArrow(scan, "summary string")
    for parts in (64, 8):  # one row per task in, at most 8 rows out
        rows = rows.repartition(parts).mapInArrow(_merged(size), "summary string")
    total = Summary(size)
    for (packed,) in rows.collect():
        total.add(json.loads(packed))
    total.trim()
    return [w for w, _ in total.counts.most_common() if len(w) <= LONGEST]


@lru_cache(maxsize=2)
def processor(path: str):
    """The worker's SentencePiece processor."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Lengths(dict):
    """Pre-token -> number of tokens; unknown ones are encoded and kept while there is room."""

    def __init__(self, path: str, table: dict[str, int]):
        sp = processor(path)
        # a run of the mark alone has an empty name; encoding the empty text would miss the mark
        self.table = table | {"": 1 if sp.piece_to_id(MARK) != sp.unk_id() else len(MARK.encode())}
        super().__init__(self.table)
        self.encode = sp.encode
        self.room = len(table) + CACHE

    def __missing__(self, word: str) -> int:
        n = len(self.encode(word))
        if len(word) <= LONGEST:
            if len(self) >= self.room:
                self.clear()
                self.update(self.table)
            self[word] = n
        return n


_LENGTHS: dict[tuple, Lengths] = {}


def worker_lengths(path: str, key: str, table) -> Lengths:
    """This worker's two tiers, kept from task to task."""
    if (path, key) not in _LENGTHS:
        _LENGTHS.clear()
        _LENGTHS[path, key] = Lengths(path, table.value)
    return _LENGTHS[path, key]


def token_counts(docs: DataFrame, model: str, limit: int = 4096, table_size: int = TABLE) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every whole text.

    ``model``: path of a SentencePiece BPE model with the identity normaliser.
    """
    docs = id_text(docs)
    words = frequent_pretokens(docs, table_size)
    sp = processor(model)
    lengths = [len(x) for x in sp.encode(words, num_threads=1)] if words else []
    table = docs.sparkSession.sparkContext.broadcast(dict(zip(words, lengths, strict=True)))
    key = uuid.uuid4().hex

    def count(batches):
        find = worker_lengths(model, key, table).__getitem__
        for batch in batches:
            out = [sum(sum(map(find, part)) for part in pretoken_chunks(text.as_py())) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    return (docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
            .mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
