"""N-gram Jaccard join: grouped prefix join over distinct word shingles.

Documents whose ordered prefix and set size agree form one group; the join
runs on groups (length filter, then the number of prefix tokens a pair must
share), and only the surviving group pairs are expanded to their members and
verified on the whole sets. Links are exact: ``100 * |x & y| >= 75 * |x | y|``.

The result needs links only as far as they connect, so the pairs of a large
family of near copies are never all made: star rounds first verify every
group against one pivot per (token, length band) and label what is linked;
pairs are then enumerated only between different labels. Exact copies share
one node from the start.

Steps, each one Spark job over a held table:

1. read the texts: bounded frequency table of shingles (for the order);
2. read the texts: one node row per document and the prefix of each group,
   shuffled by token; tokens of a single group are left out while streaming;
3. star rounds and the cross-label enumeration, plain SQL joins on the token
   (a hot token is a skewed join that AQE splits);
4. components of the verified links, joined back to all documents.

Shingles are 64-bit hashes, equal sets are recognised by 96 bits and size.

Edge cases: a null text counts as empty; a text without words has an empty
set, is linked with nothing and is its own component; an empty table gives
an empty result; repeated rows give a row each; rows that share a doc_id but not their
text are documents of their own, a null doc_id is an id like any other and the smallest; texts of any length are hashed in parts; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import components, held, id_text, neighbour_labels, only_ids, row_keyed
from varloom.llm.hashing import set_hash, shingles, words
from varloom.llm.prefix_sets import SCHEMA, PostingRows, frequent_tokens, in_order, may_match, prefix_length, shared_enough, shared_postings, signed

K = 5
STAR_ROUNDS = 6  # at most; they end when few pairs are left between labels, or a round settles less than half of them
OPEN = 16        # pairs left per posting that are simply enumerated


def shingle_set(data: bytes, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    return np.unique(shingles(words(data)[0], k))


def _group_rows(docs: DataFrame, k: int, table) -> DataFrame:
    """Node rows (doc set) and, once per group and task, the group's prefix rows."""

    def scan(batches):
        order = table.value
        out = PostingRows()
        for batch in batches:
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = shingle_set(data.as_py(), k)
                n = len(s)
                if n:
                    a, b = set_hash(s)
                    prefix = in_order(s, order)[:prefix_length(n)]
                    key = signed(set_hash(prefix, n)[0])
                    out.add_id(signed(a), key, (n << 32) | (b & 0xFFFFFFFF), doc)
                    out.add_prefix(prefix, key, n)
                else:
                    out.add_id(0, 0, 0, doc)
                if out.full():
                    yield from out.batches()
        yield from out.batches()

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(scan, SCHEMA)


def _sets(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, set) of the given documents, possibly of a few others (``only_ids``)."""

    def scan(batches):
        for batch in batches:
            ids, sets, size = [], [], 0
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = shingle_set(data.as_py(), k).view(np.int64)
                ids.append(doc)
                sets.append(s)
                size += len(s)
                if size > 1 << 20:
                    yield _list_batch(ids, sets)
                    ids, sets, size = [], [], 0
            if ids:
                yield _list_batch(ids, sets)

    return (only_ids(docs, nodes).select("doc_id", F.col("text").cast("binary").alias("text"))
            .mapInArrow(scan, "node long, set array<long>"))


def _list_batch(ids, sets):
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists], ["node", "set"])


def _verified(pairs: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Held pairs (a, b) of nodes whose whole sets reach the threshold."""
    pairs = held(pairs)
    nodes = held(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    sets = held(_sets(docs, nodes, k))
    both = (pairs.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a"))
    i = F.size(F.array_intersect("sa", "sb")).cast("long")
    return held(both.filter(100 * i >= 75 * (F.size("sa") + F.size("sb") - i)).select("a", "b"))


def links(docs: DataFrame, k: int = K) -> tuple[DataFrame, DataFrame]:
    """(nodes, labels): one node per document set and the component of every linked node.

    nodes: doc_id, n, a, b (set identity), node (smallest doc_id with the set), key (group).
    labels: node, component.
    """
    docs = id_text(docs)
    table = frequent_tokens(docs, lambda data: iter((shingle_set(data, k),)))
    rows = held(shared_postings(_group_rows(docs, k, table)))
    members = rows.filter("doc is not null").select(
        F.col("doc").alias("doc_id"), F.shiftright("np", 32).alias("n"), F.col("token").alias("a"),
        F.col("np").bitwiseAND(0xFFFFFFFF).alias("b"), "key")
    identity = members.filter("n > 0").groupBy("a", "b", "n", "key").agg(F.min("doc_id").alias("node"))
    nodes = held(identity)
    groups = nodes.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("m"))

    post = rows.filter("doc is null").select("token", "key", F.shiftright("np", 32).alias("n"), F.col("np").bitwiseAND(0xFFFFFFFF).alias("pos"))
    post = held(post.join(groups, "key")
                 .withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3))).cast("int")))

    # members of a group against its leader and groups against pivots, then all that is left between labels
    inside = nodes.join(groups.filter("m > 1"), "key").filter("node <> leader").select(
        F.col("leader").alias("a"), F.col("node").alias("b"))
    found = _verified(_star(post, None).union(inside).distinct(), docs, k)
    labels = neighbour_labels(found)
    size = post.count()
    open_ = _open_lists(post, nodes, labels)
    left = _open_pairs(open_)
    for seed in range(1, STAR_ROUNDS + 1):
        if left <= OPEN * size:
            break
        found = found.union(_verified(_star(open_, seed), docs, k))
        labels = neighbour_labels(found)
        open_ = _open_lists(open_, nodes, labels)
        before, left = left, _open_pairs(open_)
        if 2 * left > before:  # pivots no longer settle much: what is left is unlike
            break
    found = found.union(_verified(_cross(open_, nodes, labels), docs, k))
    labels = components(found)
    return members.join(nodes, ["a", "b", "n", "key"], "left"), labels


def _open_lists(post: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Held postings of tokens under which several labels meet; lo and hi: smallest and largest label in the group."""
    label = (_named(nodes, labels).groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")))
    post = post.select("token", "key", "n", "pos", "leader", "band").join(label, "key")
    several = post.groupBy("token").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo <> hi").select("token")
    return held(post.join(several, "token", "left_semi"))


def _named(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    return (nodes.join(labels, "node", "left")
            .select("key", "node", F.coalesce("component", "node").alias("component")))


def _open_pairs(post: DataFrame) -> int:
    """Pairs of postings of one token with different labels: what the enumeration would make."""
    per = post.groupBy("token", "lo").agg(F.count("*").alias("m"))
    lists = per.groupBy("token").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("same"))
    return int(lists.agg(F.sum((F.col("m") * F.col("m") - F.col("same")) / 2)).first()[0] or 0)


def _star(post: DataFrame, seed: int | None) -> DataFrame:
    """Pairs (pivot, leader): every group against a pivot of its length band and of the next.

    Without a seed the pivot is the smallest leader; with one it is pseudo-random per token and only
    groups of other labels are paired. This only saves later pairs, so it may skip any.
    """
    if seed is None:
        pivot = F.min(F.struct("leader", "n", "pos"))
    else:
        pivot = F.min_by(F.struct("leader", "n", "pos", "lo"), F.xxhash64("token", "leader", F.lit(seed)))
    pivots = post.groupBy("token", "band").agg(pivot.alias("p"))
    near = pivots.select("token", F.explode(F.array("band", F.col("band") - 1)).alias("band"), "p")
    pairs = post.join(near, ["token", "band"]).filter(may_match(F.col("n"), F.col("p.n"), F.col("pos"), F.col("p.pos")))
    if seed is None:
        pairs = pairs.filter(F.col("leader") != F.col("p.leader"))
    else:
        pairs = pairs.filter(F.col("lo") != F.col("p.lo"))
    return (pairs.groupBy(F.least("leader", "p.leader").alias("a"), F.greatest("leader", "p.leader").alias("b"))
            .agg(F.count("*").alias("shared"), F.first("n").alias("nx"), F.first("p.n").alias("ny"))
            .filter(shared_enough(*map(F.col, ("shared", "nx", "ny")))).select("a", "b"))


def _cross(post: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """All pairs of nodes with different labels that pass the group filters (exact)."""
    named = _named(nodes, labels)
    own = (named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
           .filter("lo <> hi").select("key"))  # groups with several labels inside
    left = post.select("token", "key", "n", "pos", "lo", "hi")
    right = left.select("token", *(F.col(c).alias(f"{c}2") for c in ("key", "n", "pos", "lo", "hi")))
    groups = (left.join(right, "token").filter("key < key2").filter("lo <> lo2 or hi <> hi2 or lo <> hi")
              .filter(may_match(*map(F.col, ("n", "n2", "pos", "pos2"))))
              .groupBy("key", "key2", "n", "n2").agg(F.count("*").alias("shared"))
              .filter(shared_enough(*map(F.col, ("shared", "n", "n2")))).select("key", "key2"))
    groups = groups.union(own.select("key", F.col("key").alias("key2")))
    x, y = named.alias("x"), named.select(F.col("key").alias("key2"), F.col("node").alias("node2"), F.col("component").alias("component2"))
    return (groups.join(x, "key").join(y, "key2").filter("component <> component2")
            .select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct())


@row_keyed("doc_id", "component_id")
def ngram_components(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    members, labels = links(docs, k)
    return (members.join(labels, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "node", "doc_id").alias("component_id")))
