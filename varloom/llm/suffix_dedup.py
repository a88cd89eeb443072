"""Suffix-array dedup: bytes of a long string that also starts earlier go.

A text's byte goes when a string of ``length`` bytes (100) covers it that also
starts earlier: in a document with a smaller doc_id, or further up in the same one. Texts are UTF-8
bytes; strings never cross documents and are judged on the input.

Equal strings must meet in one shard, and only strings that can repeat need sorting:

1. Each string has an anchor, the place of its smallest hash of ``GRAM``
   bytes (leftmost on ties), so equal strings have equal anchors. Anchors are found in one pass; hashes
   that occur once (summed by Spark) are out.
2. A second pass cuts the segment of all strings around each remaining anchor.
   Segments are sharded and sorted by anchor hash; an equal segment that is not the first one repeats as a whole, and is
   known for that without being sorted, in its task or when the sorted stream meets it.
3. The different segments of an anchor lose the bytes that no other one shares with them; what is left, if it is long
   enough, is concatenated to texts of about ``SHARD`` bytes and sorted by external induced sorting (``induced``: queues that go to disk, recursion
   on names). Common prefixes of neighbours, capped at ``length``, split the suffix array
   into runs of equal strings; in each all but the earliest repeat.
   An anchor of more than ``HOT`` places is never held by one task: its segments are sharded by their own bytes and
   stream through, and each string of the different ones is dealt by its digest, the earliest found by an aggregate.
4. The repeated spans are merged per document and cut out.

Edge cases: a null text counts as empty; texts shorter than ``length`` keep everything;
repeated rows with one doc_id count as that document's text once if they are equal (each row is given back), and
are documents of their own, in the order of their texts' hashes, if not; a null doc_id is an id like any other and the smallest;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import bloom, bloom_hits, id_text, row_keyed, stage
from varloom.llm.hashing import U, mix
from varloom.llm.induced import suffix_array

LENGTH, GRAM = 100, 28
BLOCK = 1 << 16    # bytes whose anchors are found at once
SHARD = 8 << 20    # bytes sorted at once, at least one anchor's segments
HOT = 1 << 15      # places of an anchor whose segments one task may hold
_R = 0x9E3779B97F4A7C55
_BYTE = mix(np.arange(1, 257, dtype=U))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _INV = _powers(_R, BLOCK + LENGTH + 1), _powers(pow(_R, -1, 1 << 64), BLOCK + LENGTH + 1)


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the anchors of all strings of ``length`` bytes, in order of place."""
    n = len(data)
    if n < length:
        return np.zeros(0, U), np.zeros(0, np.int64)
    a = np.frombuffer(data, np.uint8)
    w = length - gram + 1
    hashes, places = [], []
    for at in range(0, n - length + 1, BLOCK):  # strings that start in [at, at + BLOCK)
        x = a[at:at + BLOCK + length - 1]
        total = np.zeros(len(x) + 1, U)
        np.cumsum(_BYTE[x] * _POW[:len(x)], out=total[1:])
        h = mix((total[gram:] - total[:-gram]) * _INV[:len(total) - gram])
        # the low bits give the place, so the smallest key is the leftmost smallest hash
        key = (h & U(0xFFFFFFFFFFFC0000)) | np.arange(len(h), dtype=U)
        m = len(h) - w + 1  # strings
        pad = -len(key) % w
        rows = np.append(key, np.full(pad, np.iinfo(np.uint64).max, U)).reshape(-1, w)
        ahead = np.minimum.accumulate(rows, 1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
        best = np.minimum(behind[:m], ahead[w - 1:w - 1 + m]) & U(0x3FFFF)
        place = best[np.append(True, best[1:] != best[:-1])].astype(np.int64)
        hashes.append(h[place])
        places.append(place + at)
    h, p = np.concatenate(hashes), np.concatenate(places)
    new = np.append(True, p[1:] != p[:-1])
    return h[new], p[new]


COLUMNS = ["hash", "left", "segment", "doc", "start"]
SCHEMA = "hash long, left int, segment binary, doc long, start long"


def _batch(hash_, left, segment, doc, start) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(hash_, pa.int64()), pa.array(left, pa.int32()), pa.array(segment, pa.binary()),
                                       pa.array(doc, pa.int64()), pa.array(start, pa.int64())], COLUMNS)


class _Segments:
    """Rows of first segments, and spans (hash null, ``left`` bytes from ``start``) of those met before; documents come in order."""

    def __init__(self, limit: int = 1 << 14):
        self.limit = limit
        self.seen: dict[bytes, tuple[int, int]] = {}
        self.rows: list[tuple] = []

    def add(self, doc: int, data: bytes, hashes: np.ndarray, places: np.ndarray, length: int) -> None:
        w = length - GRAM
        s, e = np.maximum(places - w, 0), np.minimum(places + length, len(data))
        covered: list[list[int]] = []
        for h, p, b, c in zip(hashes.view(np.int64).tolist(), places.tolist(), s.tolist(), e.tolist(), strict=True):
            part = data[b:c]
            name = hashlib.blake2b(part, digest_size=12, salt=(p - b).to_bytes(2, "little")).digest()
            if name not in self.seen:
                self.seen[name] = doc, b
                self.rows.append((h, p - b, part, doc, b))
            elif self.seen[name] == (doc, b):  # a repeated row
                continue
            elif covered and b <= covered[-1][1]:
                covered[-1][1] = c
            else:
                covered.append([b, c])
        self.rows += [(None, c - b, None, doc, b) for b, c in covered]

    def batches(self, rest: bool = False):
        if len(self.rows) >= self.limit or rest and self.rows:
            yield _batch(*zip(*self.rows, strict=True))
            self.rows = []


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    k = min(len(a), len(b))
    x = int.from_bytes(a[:k], "big") ^ int.from_bytes(b[:k], "big")
    return k - (x.bit_length() + 7) // 8


def trimmed(group: list[tuple], length: int) -> list[tuple]:
    """Segments of one anchor without the bytes that no other segment of it has at the same distance from the anchor.

    On either side of the anchor the longest stretch shared with another segment is that
    shared with a neighbour in sorted order. A string that repeats lies within both stretches, so a segment whose
    stretches make less than ``length`` goes.
    """
    reach = []
    for side in (lambda r: r[2][r[1]:], lambda r: r[2][:r[1]][::-1]):
        texts = [side(r) for r in group]
        order = sorted(range(len(group)), key=texts.__getitem__)
        most = [0] * len(group)
        for i, j in zip(order, order[1:]):
            n = _common(texts[i], texts[j])
            most[i], most[j] = max(most[i], n), max(most[j], n)
        reach.append(most)
    return [(r[0], left, r[2][r[1] - left:r[1] + right], r[3], r[4] + r[1] - left)
            for r, right, left in zip(group, *reach, strict=True) if left + right >= length]


FOUND = "doc long, start long, end long, segment binary"


def _runs(length: int, hot: frozenset[int] = frozenset()):
    """mapInArrow function over segments sorted by (hash, left, segment, doc, start): spans (doc, start, end).

    Of anchors in ``hot`` the different segments come out as they are, nothing is held.
    """

    def spans_of(groups: list[list[tuple]]) -> list[tuple[int, int, int]]:
        """Spans of strings that repeat between the different segments of the same anchors."""
        rows = [r for g in groups for r in g]
        text = b"\xff".join(r[2] for r in rows)  # no UTF-8 text holds this byte
        t = np.append(np.frombuffer(text, np.uint8).astype(np.uint16) + 1, 0).astype(np.uint16)
        size = np.array([len(r[2]) for r in rows])
        begin = np.cumsum(size + 1) - size - 1
        order = suffix_array(t, 258)
        owner = np.searchsorted(begin, order, side="right") - 1
        offset = order - begin[owner]
        whole = (owner >= 0) & (order < len(text)) & (offset + length <= size[owner])
        order, owner, offset = order[whole], owner[whole], offset[whole]
        # common prefix of neighbours, capped: equal over the whole length or not
        equal = np.arange(len(order) - 1)
        for k in range(length):
            equal = equal[t[order[equal] + k] == t[order[equal + 1] + k]]
            if not len(equal):
                return []
        run = np.ones(len(order), bool)
        run[equal + 1] = False
        run = np.cumsum(run)
        doc = np.array([r[3] for r in rows], np.int64)[owner]
        start = np.array([r[4] for r in rows], np.int64)[owner] + offset
        by = np.lexsort((start, doc, run))
        first = np.append(True, run[by][1:] != run[by][:-1])
        head = np.flatnonzero(first)[np.cumsum(first) - 1]  # the earliest of the run; a string may be in several segments
        later = by[(doc[by] != doc[by[head]]) | (start[by] != start[by[head]])]
        if not len(later):
            return []
        doc, start = doc[later], start[later]
        by = np.lexsort((start, doc))
        doc, start = doc[by], start[by]
        cut = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + length)))
        return list(zip(doc[cut].tolist(), start[cut].tolist(), (start[np.append(cut[1:], len(start)) - 1] + length).tolist(), strict=True))

    def scan(batches):
        out, groups, size = [], [], 0
        group: list[tuple] = []
        last = None

        def close():
            nonlocal groups, size
            if len(group) < 2:
                return
            kept: dict[tuple, tuple] = {}
            for r in sorted(trimmed(group, length), key=lambda r: r[3:]):
                first = kept.setdefault(r[1:3], r)
                if first[3:] != r[3:]:  # equal after trimming: repeats as a whole
                    out.append((r[3], r[4], r[4] + len(r[2])))
            if len(kept) > 1:
                groups.append(list(kept.values()))
                size += sum(len(r[2]) for r in kept.values())

        def batch():
            doc, start, end, segment = zip(*((*r, None)[:4] for r in out), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (doc, start, end)] + [pa.array(segment, pa.binary())],
                                              ["doc", "start", "end", "segment"])

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[0] is None:
                    out.append((r[3], r[4], r[4] + r[1]))
                elif last is not None and r[:3] == last[:3]:  # an equal segment, later in order: repeats as a whole
                    if r[3:] != last[3:]:
                        out.append((r[3], r[4], r[4] + len(r[2])))
                else:
                    if last is not None and r[0] != last[0]:
                        close()
                        group = []
                        if size >= SHARD:
                            out += spans_of(groups)
                            groups, size = [], 0
                    if r[0] in hot:
                        out.append((r[3], r[4], r[4] + len(r[2]), r[2]))
                    else:
                        group.append(r)
                    last = r
            if len(out) >= 1 << 14:
                yield batch()
                out = []
        close()
        if groups:
            out += spans_of(groups)
        if out:
            yield batch()

    return scan


def anchor_places(length: int):
    """Function of batches (doc_id, text) to (hash, doc_id, at) of every anchor."""

    def scan(batches):
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                h, p = anchors(text.as_py(), length)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array([doc] * len(h), pa.int64()), pa.array(p.astype(np.int64))], ["hash", "doc_id", "at"])

    return scan


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, start, end): spans of bytes of repeated strings; they may overlap."""
    raw = docs.select("doc_id", F.col("text").cast("binary").alias("text")).filter(F.octet_length("text") >= length)

    def hashes(batches):
        for batch in batches:
            found = [anchors(t.as_py(), length)[0] for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64) if found else [], pa.int64())], ["hash"])

    often = stage(raw.select("text").mapInArrow(hashes, "hash long").groupBy("hash").agg(F.count("*").alias("n"))
                  .filter("n > 1"), "suffix-hashes")
    wanted = bloom(often.select("hash"))
    # at most one for HOT places of the corpus
    hot = [r.hash for r in often.filter(F.col("n") > HOT).select("hash").collect()]

    def segments(batches):
        out = _Segments()
        for batch in batches:
            known = batch.column(2) if wanted is None else [None] * len(batch)
            for doc, data, places in zip(batch.column(0).to_pylist(), batch.column(1), known, strict=True):
                data = data.as_py()
                h, p = anchors(data, length)
                hit = bloom_hits(wanted.value, h.view(np.int64)) if wanted is not None else np.isin(p, places.values.to_numpy())
                if hit.any():
                    out.add(doc, data, h[hit], p[hit], length)
                    yield from out.batches()
        yield from out.batches(rest=True)

    # spans go to any shard: they are only handed through
    shard = F.coalesce("hash", F.xxhash64("doc"))
    if wanted is None:  # too many anchors for a filter: their places meet them in a join, and the documents the places
        places = raw.mapInArrow(anchor_places(length), "hash long, doc_id long, at long").join(often.select("hash"), "hash", "left_semi")
        raw = raw.join(places.groupBy("doc_id").agg(F.collect_set("at").alias("places")), "doc_id")
    rows = raw.sortWithinPartitions("doc_id").mapInArrow(segments, SCHEMA)
    if hot:
        marks = F.broadcast(docs.sparkSession.createDataFrame([(h, True) for h in hot], "hash long, hot boolean"))
        rows = rows.join(marks, "hash", "left").select(*COLUMNS, F.when(F.col("hot"), F.xxhash64(*COLUMNS[:3])).otherwise(shard).alias("shard"))
    else:
        rows = rows.withColumn("shard", shard)
    dealt = rows.repartition("shard").sortWithinPartitions(*COLUMNS).drop("shard")
    found = stage(dealt.mapInArrow(_runs(length, frozenset(hot)), FOUND), "suffix-spans")
    spans = found.filter("segment is null").select("doc", "start", "end")
    return spans.unionByName(_dealt_strings(found.filter("segment is not null"), length)) if hot else spans


def _dealt_strings(segments: DataFrame, length: int) -> DataFrame:
    """Spans of strings that repeat between segments, a row for each string; no group is gathered."""
    strings = segments.select("doc", F.col("start").alias("at"), "segment",
                              F.explode(F.sequence(F.lit(0), F.octet_length("segment") - length)).alias("i")).select(
        "doc", "at", (F.col("at") + F.col("i")).alias("start"), F.unhex(F.md5(F.substring("segment", F.col("i") + 1, F.lit(length)))).alias("string"))
    place = F.struct("doc", "start")
    # stored, so that the join reads two plain shuffles and a string with many places can be split
    earliest = stage(strings.groupBy("string").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                     .filter("first <> last").select("string", "first"), "suffix-hot-strings")
    later = strings.join(earliest, "string").filter(place != F.col("first"))
    # strings of one segment hold its anchor, so they overlap and make one span
    return stage(later.groupBy("doc", "at").agg(F.min("start").alias("start"), (F.max("start") + length).alias("end"))
                 .select("doc", "start", "end"), "suffix-hot-spans")


@row_keyed("doc_id")
def dedup_substrings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary) of every document."""
    docs = id_text(docs)
    spans = (repeated_spans(docs, length)
             .groupBy("doc").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    joined = docs.join(spans.withColumnRenamed("doc", "doc_id"), "doc_id", "left")

    @F.pandas_udf("n_removed long, n_spans long, kept binary")
    def cut(text, spans):
        import pandas as pd
        out = []
        for data, found in zip(text, spans, strict=True):
            kept, at, removed, n = [], 0, 0, 0
            for x in sorted((s["start"], s["end"]) for s in found) if found is not None else ():
                b, e = max(x[0], at), x[1]
                if n == 0 or x[0] > at:  # touching spans are one run
                    kept.append(data[at:x[0]])
                    n += 1
                removed += max(0, e - b)
                at = max(at, e)
            kept.append(data[at:])
            out.append((removed, n, b"".join(kept)))
        return pd.DataFrame(out, columns=["n_removed", "n_spans", "kept"])

    return joined.withColumn("r", cut(F.col("text").cast("binary"), "spans")).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "r.n_removed", "r.n_spans", F.sha2("r.kept", 256).alias("kept_sha256"), "r.kept")
