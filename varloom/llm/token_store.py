"""Token ids as raw binary shards, with a minimal perfect hash index for keyed access.

``write_shards`` encodes every document, closes it with an end id and writes the ids in ascending doc_id order.
A shard is one file, self-contained and raw (all numbers little-endian):

    magic 6 bytes, width 1 byte, 1 byte 0 | writer part u32 | shard of the part u32 | documents u64 | null doc_ids u64
    doc_id i64 of every document (null ones first, as 0) | ids u32 of every document
    ids, unsigned, ``width`` bytes each (2 where the vocabulary allows it, else 4), documents end to end
    one line feed

A shard holds about ``SHARD`` bytes of ids and at most ``DOCS`` documents; a longer document is a shard of its own. Spark's writer
commits the files, so a lost executor leaves none behind. ``write_index`` reads them back and
maps every (doc_id, copy) to its shard and place; ``copy`` counts rows that share a doc_id, from 0 (nearly always the only one).

The index: a key's two 64-bit hashes name a bucket of about ``BUCKET`` keys; a bucket is a minimal perfect hash by peeling a random
three-partite hypergraph (Botelho, Pagh and Ziviani): two bits per vertex say which of a key's three vertices is its own,
the rank of that vertex among the owned ones is the key's slot. A slot stores a 32-bit fingerprint of the key, so that nearly all
keys that are not there are refused without touching a shard, and (shard, row, offset, ids). Keys need not be stored. A look-up costs
three hashes, one slot and one slice of a shard, whatever the number of documents; the doc_id in the shard then proves it.

``look_up`` and ``fetch`` do this for a table of keys of any size: keys meet their buckets, hits meet
their shards, in blocks of a bounded size; shards without a hit are not read beyond their names.

Edge cases: null texts count as empty (the end id alone); a null doc_id is a key like any other and comes first; rows that share a
doc_id are ordered by their texts' hashes and told apart by ``copy``; repeated keys are looked up once; keys that are not there give no row; an empty table gives
no shard, an index without buckets and no rows; very long texts are encoded in parts, their ids (as one document of a shard) must stay
under Spark's 2 GB for one value; further columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.llm.common import id_text, stage
from varloom.llm.hashing import mix
from varloom.llm.word_ids import id_parts, tokenizer

END = 1
SHARD = 16 << 20    # bytes of ids in a shard
DOCS = 1 << 16      # documents in a shard
BUCKET = 1 << 14    # keys in a bucket of the index
ASKED = 1 << 16     # keys that are looked up in a bucket at once
TEXTS = 1 << 22     # characters encoded at once

MAGIC = b"VLTOK1"
HEAD = struct.Struct("<6sBxIIQQ")
U = np.uint64
# odd multipliers (fixed values)
_STEP, _TURN, _NULL = 0x9E3779B97F4A7C55, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


# ---- shards

def width_of(path: str) -> int:
    """Bytes of an id: 2 for vocabularies of up to 65,536."""
    return 2 if tokenizer(path).get_vocab_size() <= 1 << 16 else 4


def write_shards(docs: DataFrame, path: str, folder: str, end: int = END, shard_bytes: int = SHARD) -> None:
    """Write the ids of ``docs`` (doc_id, text) below ``folder``."""
    docs = id_text(docs).select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("salt"))
    ordered = docs.repartitionByRange("doc_id", "h", "salt").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    width = width_of(path)

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        shard = _Shard(width)
        n = 0
        for batch in batches:
            for ids, texts in _portions(batch):
                for row, piece in id_parts([*texts], path):
                    if row != shard.row:
                        if shard.full(shard_bytes):
                            yield shard.record(part, n)
                            shard, n = _Shard(width), n + 1
                        shard.begin(row, ids[row], end)
                    shard.add(piece)
                shard.row = -1
        if len(shard.doc_ids):
            yield shard.record(part, n)

    (ordered.mapInArrow(run, "payload binary").select(F.col("payload").cast("string").alias("payload"))
     .write.option("maxRecordsPerFile", 1).option("compression", "none").option("lineSep", "\n").text(f"{folder}/shards"))


def _portions(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """(doc_ids, texts) of a batch, about TEXTS characters at once."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        ids.append(doc_id)
        texts.append(text.as_py())
        size += len(texts[-1])
        if size >= TEXTS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


class _Shard:
    """A shard that is being filled."""

    def __init__(self, width: int):
        self.width, self.row = width, -1
        self.doc_ids: list[int | None] = []
        self.sizes: list[int] = []
        self.ids: list[np.ndarray] = []
        self.total = 0

    def full(self, limit: int) -> bool:
        return self.total * self.width >= limit or len(self.doc_ids) >= DOCS

    def begin(self, row: int, doc_id: int | None, end: int) -> None:
        self.row = row
        self.doc_ids.append(doc_id)
        self.sizes.append(0)
        self.end = np.array([end], f"<u{self.width}")
        self.ids.append(self.end)  # moves back as parts come
        self.sizes[-1] += 1
        self.total += 1

    def add(self, ids: np.ndarray) -> None:
        self.ids[-1] = ids.astype(f"<u{self.width}")
        self.ids.append(self.end)
        self.sizes[-1] += len(ids)
        self.total += len(ids)

    def record(self, part: int, n: int) -> pa.RecordBatch:
        nulls = sum(d is None for d in self.doc_ids)
        data = b"".join([HEAD.pack(MAGIC, self.width, part, n, len(self.doc_ids), nulls), np.array([d or 0 for d in self.doc_ids], "<i8").tobytes(),
                         np.array(self.sizes, "<u4").tobytes(), *self.ids])
        return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["payload"])


class Shard:
    """What is in a shard's file, or in the first part of one."""

    def __init__(self, data):
        magic, self.width, self.part, self.n, docs, self.nulls = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        self.doc_ids = np.frombuffer(data, "<i8", docs, HEAD.size)
        self.sizes = np.frombuffer(data, "<u4", docs, HEAD.size + 8 * docs)
        self.first = HEAD.size + 12 * docs
        self.data = data

    def ids(self, offset: int, n: int) -> np.ndarray:
        return np.frombuffer(self.data, f"<u{self.width}", n, self.first + offset * self.width)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, content) of the shards."""
    files = spark.read.format("binaryFile").load(f"{folder}/shards").filter("length > 0")  # an empty table leaves an empty file
    return files.select(F.substring_index("path", "/", -1).alias("file"), "content")


# ---- the index

def key_hashes(doc_ids: np.ndarray, nulls: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of keys; different keys differ in at least one."""
    a = mix(doc_ids.astype(np.int64).view(U) + U(_TURN))
    return a, mix(copies.astype(U) * U(_STEP) + a + np.where(nulls, U(_NULL), U(0)))


def bucket_of(a: np.ndarray, b: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(a ^ (b * U(_TURN))) % U(buckets)).astype(np.int64)


def print_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (mix(b + a * U(_STEP)) >> U(32)).astype(np.uint32)


def vertices(a: np.ndarray, b: np.ndarray, seed: int, third: int) -> np.ndarray:
    """The three vertices of every key, one in each part of the graph."""
    x = mix(a + U(seed * _STEP & 0xFFFFFFFFFFFFFFFF)) + b
    return np.array([(mix(x + U(i * _TURN & 0xFFFFFFFFFFFFFFFF)) % U(third)).astype(np.int64) + i * third for i in range(3)])


NOT_OWNED = 3


def peel(a: np.ndarray, b: np.ndarray) -> tuple[int, int, np.ndarray]:
    """(seed, third, marks): the minimal perfect hash of different keys.

    Rounds take off every key that has a vertex to itself, which becomes its own; backwards, a key's mark is set so that its three marks
    add up to the number of its own vertex. A graph that does not come apart is drawn anew.
    """
    n = len(a)
    third = int(1.23 * n / 3) + 4
    for seed in range(1000):
        v = vertices(a, b, seed, third)
        degree = np.bincount(v.ravel(), minlength=3 * third)
        held = np.zeros(3 * third, np.int64)  # the keys at a vertex, xor-ed
        for row in v:
            np.bitwise_xor.at(held, row, np.arange(n))
        rounds, left = [], n
        while left:
            alone = np.flatnonzero(degree == 1)
            if not len(alone):
                break
            keys, first = np.unique(held[alone], return_index=True)
            rounds.append((keys, alone[first]))
            left -= len(keys)
            for row in v:
                np.subtract.at(degree, row[keys], 1)
                np.bitwise_xor.at(held, row[keys], keys)
        if left:
            continue
        marks = np.full(3 * third, NOT_OWNED, np.uint8)
        for keys, own in reversed(rounds):
            others = marks[v[:, keys]].astype(np.int64).sum(0) - NOT_OWNED  # its own is not marked yet
            marks[own] = (own // third - others) % 3
        return seed, third, marks
    raise ValueError("the keys are not different")


def packed_marks(marks: np.ndarray) -> bytes:
    """Four marks a byte."""
    m = np.concatenate([marks, np.zeros(-len(marks) % 4, np.uint8)]).reshape(-1, 4)
    return (m << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8).tobytes()


def slots_of(a: np.ndarray, b: np.ndarray, seed: int, third: int, data: bytes) -> np.ndarray:
    """The slot of every key: its own if it is in the bucket, any or none (-1) if not."""
    marks = (np.frombuffer(data, np.uint8)[:, None] >> np.array([0, 2, 4, 6], np.uint8) & 3).ravel()[:3 * third]
    rank = np.cumsum(marks != NOT_OWNED) - 1
    v = vertices(a, b, seed, third)
    own = v[marks[v].astype(np.int64).sum(0) % 3, np.arange(len(a))]
    return np.where(marks[own] == NOT_OWNED, -1, rank[own])


INDEX = "bucket long, seed int, third int, marks binary, prints binary, shards binary, rows binary, offsets binary, sizes binary"


def running(df: DataFrame, order: str, value: str, name: str, tree: int = 1024) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows before it. In two levels of up to ``tree`` consecutive ``order`` numbers a group."""
    group = F.call_function("div", order, F.lit(tree))
    sums = df.groupBy(group.alias("__g")).agg(F.sum(value).alias("__s"))
    before = Window.orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("__g", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__b"))
    inside = Window.partitionBy("__g").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("__g", group).join(sums, "__g")
            .withColumn(name, F.col("__b") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("__g", "__b"))


def write_index(spark: SparkSession, folder: str) -> None:
    """Read the shards below ``folder`` back and write their list and the index of their documents beside them."""

    def heads(batches):
        for batch in batches:
            out = []
            for data in batch.column(1):
                s = Shard(data.as_buffer())
                keys = list(zip((np.arange(len(s.doc_ids)) < s.nulls).tolist(), s.doc_ids.tolist(), strict=True))
                first_run = next((i for i, k in enumerate(keys) if k != keys[0]), len(keys))
                last_run = next((i for i, k in enumerate(reversed(keys)) if k != keys[-1]), len(keys))
                out.append((s.part, s.n, len(keys), int(s.sizes.sum(dtype=np.int64)), *keys[0], *keys[-1], first_run, last_run, s.nulls, s.doc_ids.tobytes(), s.sizes.tobytes()))
            names = ["part", "n", "docs", "tokens", "first_null", "first_id", "last_null", "last_id", "first_run", "last_run", "nulls", "doc_ids", "sizes"]
            kinds = [pa.int64()] * 4 + [pa.bool_(), pa.int64()] * 2 + [pa.int64()] * 3 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in out], k) for i, k in enumerate(kinds))], ["file", *names])

    head = F.substring("content", 1, HEAD.size + 12 * DOCS)
    found = stage(_files(spark, folder).select("file", head.alias("head")).mapInArrow(
        heads, "file string, part long, n long, docs long, tokens long, first_null boolean, first_id long, last_null boolean, last_id long, "
               "first_run long, last_run long, nulls long, doc_ids binary, sizes binary"), "store-heads")
    # number the shards: a writer's part after the other, its shards in order
    parts = running(found.groupBy("part").agg(F.count("*").alias("shards")), "part", "shards", "base").select("part", "base")
    listed = found.join(parts, "part").withColumn("shard", F.col("base") + F.col("n")).drop("base")
    listed = running(running(listed, "shard", "docs", "first_doc"), "shard", "tokens", "first_token")
    # rows of the first doc_id that lie in the shards before: the run of a doc_id begins where it is a shard's last for the first time
    runs = listed.groupBy("last_null", "last_id").agg(F.min(F.col("first_doc") + F.col("docs") - F.col("last_run")).alias("run"))
    runs = runs.toDF("first_null", "first_id", "run")
    listed = listed.join(runs, ["first_null", "first_id"], "left").withColumn(
        "copies_before", F.greatest(F.lit(0), F.col("first_doc") - F.coalesce("run", "first_doc")))
    listed = stage(listed.select("shard", "file", "docs", "tokens", "first_doc", "first_token", "copies_before", "nulls", "doc_ids", "sizes"), "store-list")
    listed.drop("nulls", "doc_ids", "sizes", "copies_before").write.parquet(f"{folder}/list")

    buckets = max(1, -(-(listed.agg(F.sum("docs")).first()[0] or 0) // BUCKET))
    entries = listed.select("shard", "copies_before", "nulls", "doc_ids", "sizes").mapInArrow(
        _entries(buckets), "bucket long, a long, b long, shard long, row long, offset long, size long")
    # a range partitioning by bucket also groups by it, and lets a reader skip files
    (entries.repartitionByRange("bucket").groupBy("bucket").applyInArrow(_bucket, INDEX).write.parquet(f"{folder}/index"))


def _entries(buckets: int):
    def run(batches):
        for batch in batches:
            for shard, before, nulls, doc_ids, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc_ids, sizes = np.frombuffer(doc_ids, "<i8"), np.frombuffer(sizes, "<u4").astype(np.int64)
                n = len(doc_ids)
                null = np.arange(n) < nulls
                first = np.ones(n, bool)
                first[1:] = (doc_ids[1:] != doc_ids[:-1]) | (null[1:] != null[:-1])
                begins = np.flatnonzero(first)
                copies = np.arange(n) - begins[np.cumsum(first) - 1]
                copies[:begins[1] if len(begins) > 1 else n] += before
                a, b = key_hashes(doc_ids, null, copies)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (bucket_of(a, b, buckets), a.view(np.int64), b.view(np.int64), np.full(n, shard, np.int64), np.arange(n), np.cumsum(sizes) - sizes, sizes)],
                    ["bucket", "a", "b", "shard", "row", "offset", "size"])

    return run


def _bucket(table: pa.Table) -> pa.Table:
    column = {name: table.column(name).to_numpy() for name in table.column_names}
    a, b = column["a"].view(U), column["b"].view(U)
    seed, third, marks = peel(a, b)
    data = packed_marks(marks)
    by_slot = np.argsort(slots_of(a, b, seed, third, data))
    values = [int(column["bucket"][0]), seed, third, data, print_of(a, b)[by_slot].tobytes()]
    values += [column[c][by_slot].astype("<u4").tobytes() for c in ("shard", "row", "offset", "size")]
    kinds = [pa.int64(), pa.int32(), pa.int32()] + [pa.binary()] * 6
    names = [f.split()[0] for f in INDEX.split(", ")]
    return pa.table([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)


# ---- keyed access

def look_up(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """(doc_id, copy, shard, row, offset, n_tokens) of the keys (doc_id, copy) that the index knows, each once."""
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    docs = spark.read.parquet(f"{folder}/list").agg(F.sum("docs")).first()[0] or 0
    buckets = max(1, -(-docs // BUCKET))
    keys = keys.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("copy").cast("long").alias("copy")).distinct()
    blocks = max(1, -(-keys.count() // (buckets * ASKED // 2)))

    def hashed(batches):
        for batch in batches:
            doc_ids = batch.column(0).fill_null(0).to_numpy()
            a, b = key_hashes(doc_ids, batch.column(0).is_null().to_numpy(zero_copy_only=False), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bucket_of(a, b, buckets)), pa.array((a % U(blocks)).astype(np.int64))],
                                             ["doc_id", "copy", "bucket", "block"])

    asked = (keys.mapInArrow(hashed, "doc_id long, copy long, bucket long, block long")
             .groupBy("bucket", "block").agg(F.collect_list(F.struct("doc_id", "copy")).alias("keys")))
    return asked.join(index, "bucket").drop("bucket", "block").mapInArrow(
        _find, "doc_id long, copy long, shard long, row long, offset long, n_tokens long")


def _find(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            keys = batch.column(0)[i].values
            doc_id, copy = keys.field(0), keys.field(1)
            seed, third, marks, prints, *places = (batch.column(c)[i].as_py() for c in range(1, batch.num_columns))
            a, b = key_hashes(doc_id.fill_null(0).to_numpy(), doc_id.is_null().to_numpy(zero_copy_only=False), copy.to_numpy())
            slot = slots_of(a, b, seed, third, marks)
            known = np.flatnonzero((slot >= 0) & (np.frombuffer(prints, np.uint32)[slot] == print_of(a, b)))
            at = slot[known]
            yield pa.RecordBatch.from_arrays([doc_id.take(pa.array(known)), copy.take(pa.array(known)), *(pa.array(np.frombuffer(p, "<u4")[at].astype(np.int64)) for p in places)],
                                             ["doc_id", "copy", "shard", "row", "offset", "n_tokens"])


def fetch(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """doc_id, copy, start (ids of all documents before), n_tokens, ids (little-endian unsigned 32-bit) of the keys that are stored."""
    hits = look_up(spark, folder, keys)
    # at most DOCS documents lie in a shard
    wanted = hits.groupBy("shard").agg(F.collect_list(F.struct("doc_id", "copy", "row", "offset", "n_tokens")).alias("hits"))
    wanted = wanted.join(spark.read.parquet(f"{folder}/list").select("shard", "file", "first_token"), "shard").drop("shard")
    return wanted.join(_files(spark, folder), "file").select("content", "first_token", "hits").mapInArrow(
        _read, "doc_id long, copy long, start long, n_tokens long, ids binary")


def _read(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            shard, first = Shard(batch.column(0)[i].as_buffer()), batch.column(1)[i].as_py()
            hits = batch.column(2)[i].values
            doc_ids, copies, rows, offsets, sizes = (hits.field(f) for f in range(5))
            row = rows.to_numpy()
            # the doc_id of the shard proves the hit
            null = doc_ids.is_null().to_numpy(zero_copy_only=False)
            right = (shard.doc_ids[row] == doc_ids.fill_null(0).to_numpy()) & ((row < shard.nulls) == null)
            out, held = [], 0
            for at in np.flatnonzero(right).tolist():
                offset, size = offsets[at].as_py(), sizes[at].as_py()
                out.append((doc_ids[at].as_py(), copies[at].as_py(), first + offset, size, shard.ids(offset, size).astype("<u4").tobytes()))
                held += size
                if held >= 1 << 20:
                    yield _records(out)
                    out, held = [], 0
            yield _records(out)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = ["doc_id", "copy", "start", "n_tokens", "ids"], [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def keys_of(docs: DataFrame) -> DataFrame:
    """(doc_id, copy) of every row."""
    counts = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count("*").alias("n"))
    return counts.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))


def store(docs: DataFrame, path: str, folder: str, end: int = END) -> None:
    """Shards and index of ``docs`` (doc_id, text) below ``folder``, which must be new."""
    write_shards(docs, path, folder, end)
    write_index(docs.sparkSession, folder)
