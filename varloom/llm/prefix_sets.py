"""Prefix-filter building blocks shared by the set-similarity joins.

Sets are sorted arrays of 64-bit token hashes. The global token order puts
tokens of the bounded frequency table last (commonest at the end) and all
others first, by hash; every total order is valid for prefix filtering, so
the table steers cost only, never results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.hashing import Frequent, U

TABLE = 1 << 16   # entries of the broadcast frequency table (16 bytes each: 1 MiB)
PER_TASK = 1 << 12  # counters each task hands on
I64 = np.int64


def frequent_tokens(docs: DataFrame, token_sets: Callable[[bytes], Iterator[np.ndarray]],
                    per_task: int = PER_TASK, table: int = TABLE):
    """Broadcast (sorted keys, rank) of the commonest tokens of all documents.

    Every task reads its whole input and hands on at most ``per_task``
    counters; Spark sums them and the ``table`` largest sums are kept.
    ``docs``: (doc_id, text); ``token_sets`` yields the sets of one text.
    """

    def tokens(batches):
        for batch in batches:
            for data in batch.column(0):
                yield from token_sets(data.as_py())

    return counted_tokens(docs.select(F.col("text").cast("binary").alias("text")), tokens, per_task, table)[0]


def counted_tokens(docs: DataFrame, tokens: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]],
                   per_task: int = PER_TASK, table: int = TABLE):
    """(the table of ``frequent_tokens``, number of tokens in all); ``tokens`` yields those of the batches of a task."""

    def scan(batches):
        top, n = Frequent(per_task), 0
        for s in tokens(batches):
            top.add(s)
            n += len(s)
        top.flush()
        yield pa.RecordBatch.from_arrays([pa.array(top.keys.view(I64)), pa.array(top.counts)], ["token", "n"])
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([n], pa.int64())], ["token", "n"])

    counted = (docs.mapInArrow(scan, "token long, n long")
               .groupBy("token").agg(F.sum("n").alias("n")).filter("n > 1 or token is null")
               .orderBy(F.col("token").isNotNull(), F.desc("n"), "token").limit(table + 1))
    rows = counted.toArrow()
    total = rows["n"][0].as_py() if len(rows) else 0  # the row without a token comes first
    rows = rows.slice(1)
    keys = rows["token"].to_numpy().view(U)
    counts = rows["n"].to_numpy()
    rank = np.empty(len(keys), np.int64)
    rank[np.lexsort((keys, counts))] = np.arange(len(keys))
    order = np.argsort(keys)
    return docs.sparkSession.sparkContext.broadcast((keys[order], rank[order])), total


def in_order(s: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A sorted set in the global order: unlisted tokens by hash, then listed ones by rank."""
    keys, rank = table
    if not len(keys) or not len(s):
        return s
    at = np.searchsorted(keys, s)
    at[at == len(keys)] = 0
    hit = keys[at] == s
    if not hit.any():
        return s
    listed = s[hit]
    return np.concatenate([s[~hit], listed[np.argsort(rank[at[hit]])]])


def prefix_length(n: int) -> int:
    """Tokens that must be indexed for Jaccard >= 3/4: n - ceil(3n/4) + 1."""
    return n - -(-3 * n // 4) + 1


NAMES = ["token", "key", "np", "doc"]
SCHEMA = "token long, key long, np long, doc long"


SHARED = 4  # prefix tokens that a pair must share (fewer where the index holds fewer)


def _needed(nx: Column, ny: Column) -> Column:
    """Smallest intersection i with 100 * i >= 75 * (nx + ny - i)."""
    return F.ceil(3 * (nx + ny) / F.lit(7.0)).cast("long")


def may_match(nx: Column, ny: Column, px: Column, py: Column) -> Column:
    """Filters of one shared prefix token of two sets (sizes n, positions p of the token).

    Length: 3/4 of the larger size at least. Prefix: a pair with an intersection of ``need`` shares SHARED tokens among the
    first ``n - need + SHARED`` of each. Position: what can match before the token, and from it on, is enough.
    """
    need = _needed(nx, ny)
    return ((4 * nx >= 3 * ny) & (4 * ny >= 3 * nx) & (px < nx - need + SHARED) & (py < ny - need + SHARED)
            & (F.least(px, py) + F.least(nx - px, ny - py) >= need))


def shared_enough(shared: Column, nx: Column, ny: Column) -> Column:
    """Whether a pair shares as many of the tokens that ``may_match`` lets pass as it must to reach the threshold.

    Every such token of a pair that does reach it passes the position filter, so none is missing in the count.
    """
    index = lambda n: 1 - F.ceil(3 * n / F.lit(4.0)).cast("long")  # noqa: E731  prefix length minus size
    return shared >= F.least(F.least(index(nx), index(ny)) + _needed(nx, ny), F.lit(SHARED))


def bits_agree(bx: Column, by: Column, nx: Column, ny: Column) -> Column:
    """Whether two sets may reach the threshold by their parity bits (bit h of 64: the parity of the tokens that hash to h).

    Every token of only one of them turns one bit, so no more bits differ than tokens.
    """
    return F.bit_count(bx.bitwiseXOR(by)) <= nx + ny - 2 * _needed(nx, ny)


class PostingRows:
    """Collects prefixes and id rows and yields record batches of a bounded size.

    A prefix row is (token, key, size << 32 | position, null); an id row is
    whatever four longs the operator passes, with a doc.
    """

    def __init__(self, limit: int = 1 << 18):
        self.limit, self.seen = limit, set()
        self._clear()

    def _clear(self) -> None:
        self.ids: list[tuple[int, int, int, int]] = []
        self.prefixes: list[np.ndarray] = []
        self.keys: list[int] = []
        self.sizes: list[int] = []
        self.n = 0

    def add_id(self, token: int, key: int, np_: int, doc: int) -> None:
        self.ids.append((token, key, np_, doc))
        self.n += 1

    def add_prefix(self, prefix: np.ndarray, key: int, size: int) -> None:
        """Once per key and task."""
        if key not in self.seen:
            self.seen.add(key)
            self.prefixes.append(prefix)
            self.keys.append(key)
            self.sizes.append(size)
            self.n += len(prefix)

    def full(self) -> bool:
        return self.n >= self.limit

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.ids:
            table = np.array(self.ids, dtype=I64)
            yield pa.RecordBatch.from_arrays([pa.array(table[:, j]) for j in range(4)], NAMES)
        if self.prefixes:
            lengths = np.array([len(p) for p in self.prefixes])
            starts = np.cumsum(lengths) - lengths
            place = np.arange(lengths.sum()) - np.repeat(starts, lengths)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(self.prefixes).view(I64)), pa.array(np.repeat(np.array(self.keys, I64), lengths)),
                pa.array(np.repeat(np.array(self.sizes, I64) << 32, lengths) + place), pa.nulls(len(place), pa.int64())], NAMES)
        self._clear()


def signed(x: int) -> int:
    """A 64-bit hash as Spark's long."""
    return x - (1 << 64) if x >> 63 else x


def shared_postings(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Postings of tokens that two or more groups have in their prefix.

    ``rows``: (token, key, np, doc); rows with a doc are passed through. One
    shuffle by token, sorted; a streaming pass with a state of one row
    collapses equal (token, key) and leaves out tokens of a single key, so
    a token of any frequency needs no memory.
    """

    def collapse(batches):
        pending = None          # first row of the last token, not yet handed on
        token = key = None      # last token and key seen
        several = False         # the last token has two keys or more
        for batch in batches:
            t, k, p, d = (batch.column(j) for j in range(4))
            is_doc = np.asarray(d.is_valid())
            if is_doc.any():
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(is_doc)) for c in (t, k, p, d)], NAMES)
            keep = ~is_doc
            t, k, p = (np.asarray(c)[keep] for c in (t, k, p))
            if not len(t):
                continue
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (k[1:] != k[:-1])
            new[0] = not (token is not None and t[0] == token and k[0] == key)
            t, k, p = t[new], k[new], p[new]
            if not len(t):
                continue
            fresh = token is None or t[0] != token
            if pending is not None:
                if not fresh:
                    t, k, p = np.append(pending[0], t), np.append(pending[1], k), np.append(pending[2], p)
                    several = True
                pending = None
            starts = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
            lengths = np.diff(np.append(starts, len(t)))
            ok = lengths > 1
            if not fresh and several:
                ok[0] = True
            several = bool(ok[-1])
            token, key = t[-1], k[-1]
            if not several:
                pending = (t[-1], k[-1], p[-1])
            mask = np.repeat(ok, lengths)
            if mask.any():
                t, k, p = t[mask], k[mask], p[mask]
                yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(k), pa.array(p), pa.nulls(len(t), pa.int64())],
                                                 NAMES)

    dealt = rows.repartition(partitions, "token") if partitions else rows.repartition("token")
    return dealt.sortWithinPartitions("token", "key").mapInArrow(collapse, SCHEMA)
