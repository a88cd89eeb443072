"""Reading tables, staging intermediate tables and connected components."""

from __future__ import annotations

import gc
import io
import os
import zipfile
from functools import wraps

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.llm.hashing import mix
from varloom.session import work_dir


_SHIPPED: set[str] = set()
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once per application), through the shared folder.

    Also lowers the rows that go to a Python worker at once from Spark's default of 10,000 to 2,048: a batch is held
    whole on both sides, and rows are texts here. A value set by the user stays; results do not depend on it.
    """
    sc = spark.sparkContext
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "2048")
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "varloom")):
            for name in sorted(names):
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), top))
    target = sc._jvm.org.apache.hadoop.fs.Path(f"{work_dir(spark, 'package')}/varloom-package.zip")
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data.getvalue()))
    out.close()
    sc.addPyFile(target.toString())
    _SHIPPED.add(sc.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with the two columns the operators read; a null text is empty."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return id_text(docs)


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of any frame that has both columns, null text as the empty text."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def row_keys(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` under ids that are never null and never name two texts, and (key, id) to go back; ``docs`` itself and None where that holds anyway.

    Keys are numbers in the order of (doc_id, hash of the text), a null doc_id first; rows that share both share the key.
    One aggregate over the ids decides; only a table with null or shared ids is numbered, by a range partitioning.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("id"))
    rows, different = ids.agg(F.count("*"), F.count_distinct("id")).first()
    if rows == different:
        return docs, None
    h = F.xxhash64(F.coalesce("text", F.lit("")))
    pairs = docs.select(F.col("doc_id").cast("long").alias("__id"), h.alias("__h")).distinct()
    dealt = stage(pairs.repartitionByRange("__id", "__h").sortWithinPartitions("__id", "__h")
                  .withColumn("part", F.spark_partition_id()).withColumn("m", F.monotonically_increasing_id()), "row-keys")
    parts = dealt.groupBy("part").agg(F.count("*").alias("n"), F.min("m").alias("first"))  # a row per partition
    parts = parts.withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    names = dealt.join(parts, "part").select("__id", "__h", (F.col("base") + F.col("m") - F.col("first")).alias("__key"))
    names = stage(names, "row-key-names")
    same = docs["doc_id"].cast("long").eqNullSafe(names["__id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == names["__h"])
    keyed = docs.join(names, same).select(*(names["__key"].alias(c) if c == "doc_id" else docs[f"`{c}`"] for c in docs.columns))
    return keyed, names.select("__key", "__id")


def row_keyed(*columns: str):
    """Decorator of f(docs, ...): ``docs`` come under ``row_keys``, and ``columns`` of the result get their ids back."""

    def wrap(f):
        @wraps(f)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            ship(docs.sparkSession)
            keyed, names = row_keys(docs)
            out = f(keyed, *args, **kwargs)
            if names is None:
                return out
            for c in columns:
                key = names.toDF("key", "id")
                out = out.join(key, out[c] == key["key"], "left").select(*(key["id"].alias(c) if x == c else out[f"`{x}`"] for x in out.columns))
            return out

        return run

    return wrap


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with a table that every executor can read, so a lost
    executor costs only its running tasks.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    # the write's own plan is garbage now; collecting it lets Spark's cleaner delete its shuffle files
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


BLOCKS = 8  # parts of a held table that a task reads, while all cores have some


def held(df: DataFrame) -> DataFrame:
    """``df`` computed once; every part of it is kept on the disks of two executors and goes when nothing reads it any more.

    Cuts the lineage as ``stage`` does, without a file for every part: on a shared folder that is a mounted path an
    executor starts two processes (chmod) for each file it writes, and has its memory counted again while one starts. Spark makes
    another copy where an executor is lost.
    """
    df = df.localCheckpoint(True, StorageLevel.DISK_ONLY_2)
    # as in ``stage``; here also for the parts of tables that nothing reads any more
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    parts = df.rdd.getNumPartitions()
    few = max(2, df.sparkSession.sparkContext.defaultParallelism, parts // BLOCKS)
    return df.coalesce(few) if few < parts else df


KEY_BITS = 16                             # bits of a Bloom filter per key: some 1.4 % of other keys pass
FEW = 1 << 20                             # ids that are broadcast instead: some 20 MB
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27  # of a filter: 128 KiB to 16 MiB


def _bits(columns, bits: int) -> list[np.ndarray]:
    h = np.zeros(len(columns[0]), np.uint64)
    for x in columns:
        h = mix(h + np.asarray(x, np.int64).view(np.uint64))
    last = np.uint64(bits - 1)
    return [((h >> np.uint64(32)) & last).astype(np.int64), (h & last).astype(np.int64)]


def bloom(ids: DataFrame):
    """Broadcast Bloom filter of the long columns of ``ids`` (stored, or cheap to count), KEY_BITS for each row; None where that is more than MOST_BITS.

    Has no false negatives, and at every size it is given for as few false positives. Callers do the same work by a join where it
    is None, so nothing that is broadcast grows beyond the bound and no filter fills up.
    """
    rows = ids.count()
    if rows * KEY_BITS > MOST_BITS:
        return None
    bits = max(LEAST_BITS, 1 << (rows * KEY_BITS - 1).bit_length() if rows else 0)

    def build(batches):
        here = np.zeros(bits, bool)
        for batch in batches:
            for at in _bits(batch.columns, bits):
                here[at] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(here).tobytes()], pa.binary())], ["bits"])

    merged = np.zeros(bits // 8, np.uint8)
    for (part,) in ids.repartition(4).mapInArrow(build, "bits binary").collect():  # four filters
        merged |= np.frombuffer(part, np.uint8)
    return ids.sparkSession.sparkContext.broadcast(merged)


def bloom_hits(bits: np.ndarray, *columns) -> np.ndarray:
    """Which rows may be in the filter."""
    out = np.ones(len(columns[0]), bool)
    for at in _bits(columns, 8 * len(bits)):
        out &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    return out


def only_ids(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids`` (one column): those and possibly a few others, without a shuffle of ``docs``, or by a semi-join where the ids are too many for a filter.

    Up to FEW ids are broadcast as they are: a filter needs a Python worker of its own in every task, beside that of the caller's scan.
    """
    if ids.count() <= FEW:
        return docs.join(F.broadcast(ids.toDF(column).distinct()), column, "left_semi").select(*docs.columns)
    shared = bloom(ids)
    if shared is None:
        return docs.join(ids.toDF(column), column, "left_semi")

    @F.pandas_udf("boolean")
    def hit(x: pd.Series) -> pd.Series:
        return pd.Series(bloom_hits(shared.value, x))

    return docs.filter(hit(column))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable id of every node in ``edges`` (undirected): (node, component).

    Alternating large-star and small-star steps: each is one partial
    aggregate (``min``) and one join on the node, so a node with a third of
    all edges is a skewed join that AQE splits, never one collected group.
    Nodes must be longs. Every step is held (``held``).
    """
    e = held(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
              .filter("u <> v").distinct())
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    before = None
    while True:  # the smallest ids only ever move down
        both = e.union(e.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: every larger neighbour moves to the smallest one
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        # small star: smaller neighbours (and the node) move to the smallest
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        e = held(small.filter("u <> v").distinct())
        # stars of smallest nodes are the fixed point: the same edges come out again
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state


def neighbour_labels(edges: DataFrame) -> DataFrame:
    """(node, component): a label that only connected nodes share, in a bounded number of steps.

    The smallest neighbour, followed twice. Cheaper than ``components`` and finer: nodes of
    one component may have several labels.
    """
    low = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("v")).groupBy("node").agg(F.min("v").alias("component"))
    low = held(low)
    up = low.select(F.col("node").alias("component"), F.col("component").alias("next"))
    for _ in range(2):
        low = low.join(up, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
    return held(low)


def aside(docs: DataFrame, name_of: str | None = None):
    """(frame with doc_id, text and all other columns under names nobody else uses, function back to ``docs``'s columns).

    With ``name_of`` only the name given to that column, None where there is none.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    names = {c: f"__aside_{i}" for i, c in enumerate(others)}
    if name_of:
        return names.get(name_of)
    inner = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    return inner, lambda df: df.select(*(F.col(names.get(c, c)).alias(c) for c in docs.columns))
