"""Landed JSON documents of any size, read by many tasks (O6).

A landed document is one JSON value, often one line, so no line reader can split it. Here it is cut at its closing braces, which Spark's
text reader finds from any place in a file, and each block of a file is read by a task of its own. A task cannot know whether its block begins
inside a string or how deep, so two scans of the bytes answer that:

1. A block is summed up under both assumptions (begins outside a string, begins inside one): whether its quotes are odd, how its depth changes, its
   lowest depth, and the outermost place where a ``"responses": [`` opens. The sums of a file's blocks, in order, compose: one fold over a row per block
   gives the state in which every block begins.
2. With that state each block is cut where a response ends. What lies before a block's first end and after its last one are pieces of
   responses that cross blocks; they are put together by a count of the ends before them.

A document is an array of responses, an object with such an array under ``responses``, or a single response. No value is ever longer
than a response or the distance between two closing braces. The states of the blocks, a row of some 40 bytes for each
``spark.sql.files.maxPartitionBytes`` of input, are broadcast.

The text must be valid JSON; what stands before, between and after the responses is dropped; an element that is no object is no
response. Documents need not end with a line feed, may begin with a byte order mark, and strings may hold any bracket, brace or escape.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# the tasks' code travels with the plan: executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE, ESCAPE, CLOSE, END_LIST = b'"'[0], b"\\"[0], b"}"[0], b"]"[0]
LIST_KEY = re.compile(rb'"responses"\s*:\s*\[')
BETWEEN = b"\xef\xbb\xbf, \t\r\n"
ARRAY, LISTED, SINGLE = 1, 2, 0  # kinds of documents: the depth at which a response has just ended
FAR = 1 << 40

SUMS = "file long, start long, array boolean, " + ", ".join(f"odd{s} boolean, net{s} long, low{s} long, key{s} long, after{s} long" for s in (0, 1))
STATES = "file long, start long, quoted boolean, depth long, inside boolean, kind int"


def segments(spark, root: str, names: str, path_of) -> DataFrame:
    """(value, file, start, path) of the documents' segments: text up to and with a closing brace; rows of a block are in order."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", names).option("lineSep", "}")
    path = path_of(F.col("_metadata.file_path"))
    return reader.text(root).select(F.concat("value", F.lit("}")).cast("binary").alias("value"), F.xxhash64("_metadata.file_path").alias("file"),
                                    F.col("_metadata.file_block_start").alias("start"), path.alias("path"))


class Bytes:
    """Brackets and quotes of consecutive segments."""

    def __init__(self, data: np.ndarray):
        self.data = data
        quote = data == QUOTE
        escape = data == ESCAPE
        if escape.any():  # a quote after an odd number of backslashes is part of its string
            at = np.arange(len(data))
            plain = np.maximum.accumulate(np.where(escape, -1, at))
            before = np.concatenate([[-1], plain[:-1]])
            quote &= (at - 1 - before) % 2 == 0
        self.quote = quote
        self.quotes = np.cumsum(quote)
        opens = (data == ord("{")) | (data == ord("["))
        self.places = np.flatnonzero(opens | (data == CLOSE) | (data == END_LIST))
        self.marks = np.where(opens[self.places], 1, -1)
        self.odd = self.quotes[self.places] & 1

    def depths(self, quoted: bool) -> tuple[np.ndarray, np.ndarray]:
        """(places, depth after each, relative) of the brackets that are not in strings."""
        real = self.odd == int(quoted)
        return self.places[real], np.cumsum(self.marks[real])

    def keys(self, quoted: bool, places: np.ndarray, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, relative depth, place after the bracket) of every ``"responses": [`` that is not in a string."""
        found = [(m.start(), m.end()) for m in LIST_KEY.finditer(self.data.tobytes())
                 if self.quote[m.start()] and (self.quotes[m.start()] - 1) % 2 == int(quoted)]
        at = np.array([f[0] for f in found], np.int64)
        upto = np.searchsorted(places, at)
        return at, np.where(upto > 0, depths[upto - 1] if len(depths) else 0, 0), np.array([f[1] for f in found], np.int64)


def runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, file, start, bytes) of the batch's blocks."""
    values = batch.column(0)
    offsets = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, 4 * values.offset)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    file, start = batch.column(1).to_numpy(), batch.column(2).to_numpy()
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(file)], strict=True):
        if b > a:
            yield a, (int(file[a]), int(start[a])), data[offsets[a]:offsets[b]]


class Sum:
    """What a block does to the state in which it begins, under one assumption."""

    def __init__(self, quoted: bool):
        self.quoted, self.now, self.net, self.low, self.key, self.after = quoted, quoted, 0, 0, FAR, FAR

    def add(self, part: Bytes) -> None:
        places, depths = part.depths(self.now)
        at, relative, _ = part.keys(self.now, places, depths)
        relative = relative + self.net
        if len(at) and relative.min() <= self.key:  # the outermost one, the last of several
            last = np.flatnonzero(relative == relative.min())[-1]
            self.key = int(relative[last])
            later = depths[np.searchsorted(places, at[last]) + 1:]  # beyond its bracket
            self.after = self.net + int(later.min()) if len(later) else FAR
        elif len(depths):
            self.after = min(self.after, self.net + int(depths.min()))
        if len(depths):
            self.low = min(self.low, self.net + int(depths.min()))
            self.net += int(depths[-1])
        self.now ^= bool(part.quotes[-1] & 1)

    def row(self) -> tuple:
        return self.now != self.quoted, self.net, self.low, (self.key if self.key < FAR else None), self.after


def sum_up(batches) -> Iterator[pa.RecordBatch]:
    """A row of SUMS per block."""
    block, sums, array = None, None, None

    def row() -> pa.RecordBatch:
        values = [*block, array, *sums[0].row(), *sums[1].row()]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), *[pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64()] * 2]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [f.split()[0] for f in SUMS.split(", ")])

    for batch in batches:
        for _, key, data in runs(batch):
            if key != block:
                if block:
                    yield row()
                block, sums, array = key, (Sum(False), Sum(True)), data[:4096].tobytes().lstrip(BETWEEN).startswith(b"[")
            part = Bytes(data)
            for s in sums:
                s.add(part)
    if block:
        yield row()


def fold(table: pa.Table) -> pa.Table:
    """The state in which every block of a file begins."""
    rows = sorted(table.to_pylist(), key=lambda r: r["start"])
    out, quoted, depth, inside, listed = [], False, 0, False, False
    for r in rows:
        out.append((r["file"], r["start"], quoted, depth, inside))
        s = int(quoted)
        low, key = depth + r[f"low{s}"], r[f"key{s}"]
        if key is not None and depth + key == 1:
            listed, inside = True, depth + r[f"after{s}"] > 1
        else:
            inside = inside and low > 1
        quoted, depth = quoted != r[f"odd{s}"], depth + r[f"net{s}"]
    kind = ARRAY if rows[0]["array"] else LISTED if listed else SINGLE
    names, kinds = [f.split()[0] for f in STATES.split(", ")], [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int32()]
    return pa.table([pa.array([(*r, kind)[i] for r in out], k) for i, k in enumerate(kinds)], names=names)


class Cutter:
    """Cuts a block, whose beginning is known, into responses and the pieces at its ends."""

    def __init__(self, quoted: bool, depth: int, inside: bool, kind: int, first: bool):
        self.quoted, self.depth, self.kind = quoted, depth, kind
        self.inside = inside or kind != LISTED
        self.head = not (first and kind != LISTED) and self.inside  # the text so far belongs to a response of a block before
        self.begun = kind == ARRAY and first                        # the array's own bracket is still to come
        self.pending: list[bytes] = []

    def add(self, data: np.ndarray) -> tuple[bytes | None, list[bytes]]:
        """(end of the response that began in a block before, whole responses) of further segments."""
        part = Bytes(data)
        places, depths = part.depths(self.quoted)
        depths = depths + self.depth
        ends = places[(data[places] == CLOSE) & (depths == self.kind)]
        opened = np.zeros(0, np.int64)  # places after which responses begin
        if self.kind == LISTED:
            key, relative, after = part.keys(self.quoted, places, depths - self.depth)
            top = relative + self.depth == 1
            opened = after[top]
            closed = places[(data[places] == END_LIST) & (depths == 1)]
            events = np.concatenate([opened, closed])
            order = np.argsort(events, kind="stable")
            is_open = np.concatenate([np.ones(len(opened), bool), np.zeros(len(closed), bool)])[order]
            last = np.searchsorted(events[order], ends) - 1
            ends = ends[np.where(last >= 0, is_open[last] if len(is_open) else False, self.inside)]
        elif self.begun and len(places):
            opened, self.begun = places[:1] + 1, False
        raw = data.tobytes()
        head, whole, at, k = None, [], 0, 0
        opened = opened.tolist()
        for end in ends.tolist():
            while k < len(opened) and opened[k] <= end:
                at, k = opened[k], k + 1
                self.pending, self.head = [], False
            text = b"".join([*self.pending, raw[at:end + 1]])
            self.pending, at = [], end + 1
            if self.head:
                head, self.head = text, False
            else:
                whole.append(text.lstrip(BETWEEN))
        while k < len(opened):
            at, k = opened[k], k + 1
            self.pending, self.head = [], False
        if self.kind == LISTED and len(events):
            self.inside = bool(is_open[-1])
        if self.inside:
            self.pending.append(raw[at:])
        else:
            self.pending, self.head = [], False
        if len(depths):
            self.depth = int(depths[-1])
        self.quoted ^= bool(part.quotes[-1] & 1)
        return head, whole


PIECES = "file long, start long, part int, ends boolean, text binary, path string"


def cut(batches) -> Iterator[pa.RecordBatch]:
    """Rows of PIECES: whole responses (part null) and the pieces at the ends of blocks (part 0 before the first end, 1 after the last)."""
    block, cutter, path = None, None, None

    def rows(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)], [f.split()[0] for f in PIECES.split(", ")])

    def rest() -> list[tuple]:
        text = b"".join(cutter.pending)
        return [(*block, 0 if cutter.head else 1, False, text, path)] if text else []

    for batch in batches:
        found = []
        for row, key, data in runs(batch):
            if key != block:
                if block:
                    found += rest()
                block, path = key, batch.column(3)[row].as_py()
                cutter = Cutter(*(batch.column(c)[row].as_py() for c in (4, 5, 6, 7)), key[1] == 0)
            head, whole = cutter.add(data)
            if head is not None:
                found.append((*block, 0, True, head, path))
            found += [(*block, None, True, text, path) for text in whole]
        if found:
            yield rows(found)
    if block and rest():
        yield rows(rest())


def landed_responses(spark, root: str, names: str, path_of) -> DataFrame:
    """(path, response) of every response of the documents below ``root`` whose file names match ``names``.

    ``path_of``: a file's path from its URI.
    """
    found = segments(spark, root, names, path_of)
    sums = found.select("value", "file", "start").mapInArrow(sum_up, SUMS)
    states = sums.groupBy("file").applyInArrow(fold, STATES)
    # a row per block; a join that dealt the segments anew would lose their order
    known = found.join(F.broadcast(states), ["file", "start"]).select("value", "file", "start", "path", "quoted", "depth", "inside", "kind")
    pieces = known.mapInArrow(cut, PIECES)
    whole = pieces.filter("part IS NULL").select("path", F.col("text").cast("string").alias("response"))
    crossing = pieces.filter("part IS NOT NULL")
    order = "PARTITION BY file ORDER BY start, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    crossing = crossing.withColumn("n", F.expr(f"coalesce(sum(int(ends)) OVER ({order}), 0)"))
    joined = (crossing.groupBy("file", "n").agg(F.first("path").alias("path"), F.max("ends").alias("ends"),
                                                F.sort_array(F.collect_list(F.struct("start", "part", F.col("text").cast("string").alias("t")))).alias("texts"))
              .filter("ends").select("path", F.expr("regexp_replace(array_join(transform(texts, x -> x.t), ''), '^[\\uFEFF, \\t\\r\\n]+', '')").alias("response")))
    return whole.unionByName(joined)
