"""Packing: cutting-stock column generation over the histogram of lengths.

Documents become token ids plus an end id and go into sequences of ``capacity``.
A document's full sequences are cut off first; what is left (under one sequence)
is packed by patterns. Lengths are put in at most ``CLASSES`` classes; a linear program chooses how
often each pattern (how many documents of each class share a sequence) is
used; a knapsack dynamic program over the dual prices finds the next pattern. The program sees
the histogram only, so its size does not depend on the corpus.

Documents are ranked by (length, doc_id) with a range partitioning, so a
length that a third of all documents have is spread over many tasks; the
rounded patterns take documents by their rank in the class. What the
full patterns leave over (rounding, patterns that are not nearly full) is laid end
to end in rank order and cut at every sequence's end: its position follows from the
histogram and the rank alone. The last part of that line is cut into powers of two, which need no padding.

Edge cases: a null text counts as empty (the end id alone); repeated rows, rows that share a
doc_id and rows without one are documents of their own; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import held, id_text, only_ids, row_keyed
from varloom.llm.word_ids import id_bytes, id_parts, packed

CAPACITY, END = 4096, 2
CLASSES = 256
FULL = 0.97      # share of a sequence that a pattern must fill
GAP = 2e-3       # the linear program ends when it is this close to its bound
STEPS = 600     # or after so many patterns


@dataclass
class Plan:
    """What is needed to place (length, rank): all arrays are bounded by the capacity and CLASSES."""

    top: np.ndarray         # class -> largest length
    start: np.ndarray       # length -> rank of its first document (all ranks count from the smallest length)
    class_start: np.ndarray  # class -> rank of its first document
    used: np.ndarray        # class -> documents in patterns
    use_from: list          # class -> rank in class at which each of its patterns begins
    use_pattern: list       # class -> pattern numbers, in that order
    use_times: list         # class -> documents of the class in one sequence of the pattern
    first_sequence: np.ndarray  # pattern -> its first sequence
    line_start: np.ndarray  # length -> place on the line of its first document there
    line_rank: np.ndarray   # length -> rank of that document
    sequences: int          # sequences of the patterns
    line: int               # tokens on the line


def column_generation(widths: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Patterns (documents per class) and how often each is used, for the least number of sequences.

    Revised simplex on the covering program; the basis begins with one pattern per class.
    """
    m = len(widths)
    patterns = [np.zeros(m) for _ in range(m)]
    for i, p in enumerate(patterns):
        p[i] = capacity // widths[i]
    inverse = np.diag([1 / p[i] for i, p in enumerate(patterns)])
    x = demand * inverse.diagonal()
    for _ in range(STEPS):
        price = np.maximum(inverse.sum(0), 0)
        value, entering = _knapsack(widths, price, capacity)
        if value <= 1 + GAP:
            break
        u = inverse @ entering
        ratio = np.where(u > 1e-9, x / np.where(u > 1e-9, u, 1), np.inf)
        r = int(np.argmin(ratio))
        if not np.isfinite(ratio[r]):
            break
        x = np.maximum(x - ratio[r] * u, 0)
        x[r] = ratio[r]
        row = inverse[r] / u[r]
        inverse -= np.outer(u, row)
        inverse[r] = row
        patterns[r] = entering
    return list(zip(patterns, x, strict=True))


def _knapsack(widths: np.ndarray, price: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern that fits, by dynamic programming over the capacity (widths ascend)."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    fits = np.searchsorted(widths, np.arange(capacity + 1), side="right")
    for c in range(int(widths[0]), capacity + 1):
        value = best[c - widths[:fits[c]]] + price[:fits[c]]
        k = int(value.argmax())
        if value[k] > best[c - 1]:
            best[c], last[c] = value[k], k
        else:
            best[c] = best[c - 1]
    out, c = np.zeros(len(widths)), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
            continue
        out[last[c]] += 1
        c -= widths[last[c]]
    return best[capacity], out


def _leftover(widths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Further full patterns for what rounding leaves, largest documents first; takes them off ``left``.

    Every turn either uses up a class or gives one up, so the number of turns is bounded by the patterns made.
    """
    out, tried = [], np.zeros(len(left), bool)
    while True:
        open_ = np.flatnonzero((left > 0) & ~tried)
        if not len(open_):
            return out
        pattern, room = np.zeros(len(left), np.int64), capacity
        for c in np.flatnonzero(left > 0)[::-1]:
            if c <= open_[-1] and room >= widths[0]:
                pattern[c] = min(left[c], room // widths[c])
                room -= pattern[c] * widths[c]
        if capacity - room < FULL * capacity:
            tried[open_[-1]] = True
            continue
        mine = pattern > 0
        times = int((left[mine] // pattern[mine]).min())
        left -= pattern * times
        out.append((pattern, times))


def make_plan(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """``counts[length]``: documents with that length left over, for lengths under the capacity."""
    lengths = np.flatnonzero(counts)
    lengths = lengths[lengths > 0]
    start = np.cumsum(counts) - counts
    total = counts[lengths].sum()
    tops = []
    seen = 0.0
    for n in lengths:  # a class ends when it has its share of documents; common lengths are their own class
        seen += counts[n]
        if seen >= total / CLASSES or n == lengths[-1] or len(lengths) <= CLASSES:
            tops.append(n)
            seen = 0.0
    top = np.array(tops, np.int64)
    cls = np.searchsorted(top, lengths)
    demand = np.bincount(cls, counts[lengths], len(top)).astype(np.int64) if len(top) else np.zeros(0, np.int64)
    class_start = np.array([start[lengths[cls == c][0]] for c in range(len(top))], np.int64)

    left = demand.copy()
    chosen: list[tuple[np.ndarray, int]] = []
    if len(top):
        solution = [(p.astype(np.int64), x) for p, x in column_generation(top, demand.astype(float), capacity)
                    if (p * top).sum() >= FULL * capacity]
        times = [int(np.floor(x + 1e-6)) for _, x in solution]
        for (p, _), t in zip(solution, times, strict=True):
            left -= p * t
        for i in sorted(range(len(solution)), key=lambda i: times[i] - solution[i][1]):  # round up where documents are left
            if (solution[i][0] <= left).all():
                times[i] += 1
                left -= solution[i][0]
        chosen = [(p, t) for (p, _), t in zip(solution, times, strict=True) if t] + _leftover(top, left, capacity)
    used = demand - left
    use_from, use_pattern, use_times = [], [], []
    for c in range(len(top)):
        mine = [(i, int(p[c]), t) for i, (p, t) in enumerate(chosen) if p[c]]
        taken = np.array([n * t for _, n, t in mine], np.int64)
        use_from.append(np.cumsum(taken) - taken)
        use_pattern.append(np.array([i for i, _, _ in mine], np.int64))
        use_times.append(np.array([n for _, n, _ in mine], np.int64))
    times = np.array([t for _, t in chosen], np.int64)

    line_start, line_rank, at = np.zeros(capacity, np.int64), np.zeros(capacity, np.int64), 0
    for n, c in zip(lengths, cls, strict=True):
        first = max(start[n], class_start[c] + used[c])
        line_start[n], line_rank[n] = at, first
        at += max(0, start[n] + counts[n] - first) * n
    return Plan(top, start, class_start, used, use_from, use_pattern, use_times, np.cumsum(times) - times,
                line_start, line_rank, int(times.sum()), int(at))


def _place(plan: Plan, capacity: int, rows: dict[str, np.ndarray]) -> list[tuple[np.ndarray, ...]]:
    """Pieces (row, start, length, sequence, offset or -1) of documents (rest, rank)."""
    rest, rank = rows["rest"], rows["rank"]
    cls = np.searchsorted(plan.top, rest)
    row = np.arange(len(rest))
    in_class = rank - plan.class_start[cls] if len(plan.top) else rank
    patterned = in_class < plan.used[cls] if len(plan.top) else np.zeros(len(rest), bool)
    out = []
    for c in np.unique(cls[patterned]):
        mine = row[patterned & (cls == c)]
        k = np.searchsorted(plan.use_from[c], in_class[mine], side="right") - 1
        instance = (in_class[mine] - plan.use_from[c][k]) // plan.use_times[c][k]
        out.append((mine, np.zeros(len(mine), np.int64), rest[mine], plan.first_sequence[plan.use_pattern[c][k]] + instance,
                    np.full(len(mine), -1)))
    mine = row[~patterned]
    if len(mine):
        at = plan.line_start[rest[mine]] + (rank[mine] - plan.line_rank[rest[mine]]) * rest[mine]
        ends = np.append(np.arange(1, plan.line // capacity + 1, dtype=np.int64)[:0], _tail_ends(plan.line, capacity))
        begin, done = at.copy(), at + rest[mine]
        while len(mine):
            full = plan.line // capacity * capacity
            # the end of the sequence that `begin` lies in: a multiple of the capacity, then the powers of two of the tail
            k = np.minimum(np.searchsorted(ends, begin, side="right"), len(ends) - 1)
            stop = np.where(begin < full, (begin // capacity + 1) * capacity, ends[k] if len(ends) else 0)
            base = np.where(begin < full, begin // capacity * capacity, np.append(full, ends)[k] if len(ends) else 0)
            number = np.where(begin < full, begin // capacity, plan.line // capacity + k)
            stop = np.minimum(stop, done)
            out.append((mine, begin - at, stop - begin, plan.sequences + number, begin - base))
            more = stop < done
            mine, at, begin, done = mine[more], at[more], stop[more], done[more]
    return out


def _tail_ends(line: int, capacity: int) -> np.ndarray:
    """Ends on the line of the power-of-two sequences that hold its last part."""
    rest, at, ends = line % capacity, line // capacity * capacity, []
    while rest:
        size = 1 << (rest.bit_length() - 1)
        at += size
        rest -= size
        ends.append(at)
    return np.array(ends, np.int64)


def _encoded(docs: DataFrame, path: str, capacity: int, end: int) -> DataFrame:
    """doc_id, h, doc_tokens, crcs (of the full sequences), rest (tokens beyond them), rest_crc."""

    def scan(batches):
        for batch in batches:
            rows = [_Crcs(capacity) for _ in range(batch.num_rows)]
            for row, ids in id_parts(batch.column(2).to_pylist(), path):
                rows[row].add(ids)
            rows = [row.closed(end) for row in rows]
            tokens, crcs, rest, rest_crc = (list(x) for x in zip(*rows, strict=True)) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens, pa.int64()), pa.array(crcs, pa.list_(pa.int64())),
                                              pa.array(rest, pa.int64()), pa.array(rest_crc, pa.int64())],
                                             ["doc_id", "h", "doc_tokens", "crcs", "rest", "rest_crc"])

    return (docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
            .mapInArrow(scan, "doc_id long, h long, doc_tokens long, crcs array<long>, rest long, rest_crc long"))


class _Crcs:
    """Checksums of a document's full sequences; what is left of its ids under one sequence."""

    def __init__(self, capacity: int):
        self.capacity, self.crcs, self.tokens, self.rest = capacity, [], 0, np.zeros(0, "<u4")

    def add(self, ids: np.ndarray) -> None:
        ids = np.concatenate([self.rest, ids]).astype("<u4", copy=False)
        self.tokens += len(ids) - len(self.rest)
        full = len(ids) - len(ids) % self.capacity
        self.crcs += [zlib.crc32(ids[at:at + self.capacity]) for at in range(0, full, self.capacity)]
        self.rest = ids[full:]

    def closed(self, end: int) -> tuple[int, list[int], int, int]:
        self.add(np.array([end], "<u4"))
        return self.tokens, self.crcs, len(self.rest), zlib.crc32(self.rest)


def _parts(text: str, path: str, end: int):
    yield from id_bytes(text, path)
    yield packed([end])


def _slices(docs: DataFrame, cuts: DataFrame, path: str, end: int) -> DataFrame:
    """(doc_id, h, start, length, ids_crc32) of cut pieces, from the documents' texts again."""

    def scan(batches):
        for batch in batches:
            out = []
            for doc, h, text, cuts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                wanted = sorted({(c["start"], c["length"]) for c in cuts})
                at, buffer, base = 0, b"", 0
                parts = _parts(text, path, end)
                for start, length in wanted:
                    while base + len(buffer) // 4 < start + length:
                        buffer += next(parts)
                        if base + len(buffer) // 4 <= start:
                            base += len(buffer) // 4
                            buffer = b""
                    at = 4 * (start - base)
                    out.append((doc, h, start, length, zlib.crc32(buffer[at:at + 4 * length])))
                    base, buffer = start, buffer[at:]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)],
                                                 ["doc_id", "h", "start", "length", "ids_crc32"])

    wanted = held(cuts.groupBy("doc_id", "h").agg(F.collect_set(F.struct("start", "length")).alias("cuts")))
    texts = only_ids(docs, wanted.select("doc_id")).withColumn("h", F.xxhash64("text")).dropDuplicates(["doc_id", "h"])
    return (texts.join(wanted, ["doc_id", "h"]).select("doc_id", "h", "text", "cuts")
            .mapInArrow(scan, "doc_id long, h long, start long, length long, ids_crc32 long"))


@row_keyed("doc_id")
def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece.

    ``path``: a tokenizer file of the kind that ``word_ids`` describes.
    """
    docs = id_text(docs)
    spark = docs.sparkSession
    encoded = held(_encoded(docs, path, capacity, end))

    # global rank by (rest, doc_id): a range partitioning and the sizes of its parts
    dealt = held(encoded.repartitionByRange("rest", "doc_id", "h").sortWithinPartitions("rest", "doc_id", "h")
                  .withColumn("part", F.spark_partition_id()).withColumn("m", F.monotonically_increasing_id()))
    parts = dealt.groupBy("part").agg(F.count("*").alias("n"), F.min("m").alias("first"))
    parts = parts.withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = dealt.join(F.broadcast(parts.select("part", "base", "first")), "part").withColumn("rank", F.col("base") + F.col("m") - F.col("first"))

    counts = np.zeros(capacity, np.int64)
    most = 0
    for r in encoded.groupBy("rest").agg(F.count("*").alias("n"), F.max(F.size("crcs")).alias("full")).collect():  # a row per length
        counts[r["rest"]] = r["n"]
        most = max(most, r["full"])
    plan = make_plan(counts, capacity)
    shared = spark.sparkContext.broadcast(plan)
    beyond = plan.sequences + plan.line // capacity + 64  # full sequences are numbered from here on

    def place(batches):
        for batch in batches:
            t = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names}
            for row, start, length, sequence, offset in _place(shared.value, capacity, t):
                if len(row):
                    whole = length == t["rest"][row]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(t["doc_id"][row]), pa.array(t["h"][row]), pa.array(t["doc_tokens"][row] - t["rest"][row] + start), pa.array(length),
                         pa.array(t["rest_crc"][row], mask=~whole), pa.array(t["doc_tokens"][row]), pa.array(sequence), pa.array(offset.astype(np.int64)),
                         pa.array(t["rank"][row])],
                        ["doc_id", "h", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "rank"])

    placed = held(ranked.filter("rest > 0").select("doc_id", "h", "doc_tokens", "rest", "rest_crc", "rank").mapInArrow(
        place, "doc_id long, h long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, rank long"))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    # a sequence of a pattern holds at most `capacity` pieces
    inside = Window.partitionBy("sequence_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    patterned = placed.filter("offset < 0").withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    line = placed.filter("offset >= 0")
    cut = line.filter("ids_crc32 is null")
    recut = cut.drop("ids_crc32").join(_slices(docs, cut, path, end), ["doc_id", "h", "start", "length"])
    full = (ranked.filter(F.size("crcs") > 0).select("doc_id", "doc_tokens", "rank", F.posexplode("crcs").alias("k", "ids_crc32"))
            .select("doc_id", (F.col("k") * F.lit(capacity).cast("long")).alias("start"), F.lit(capacity).cast("long").alias("length"), "ids_crc32", "doc_tokens",
                    (F.lit(beyond) + F.col("rank") * F.lit(max(most, 1)) + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    return (patterned.select(columns).unionByName(line.filter("ids_crc32 is not null").select(columns))
            .unionByName(recut.select(columns)).unionByName(full.select(columns)))
