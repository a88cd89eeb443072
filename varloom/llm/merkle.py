"""Merkle manifest of a dataset, with a witness per row, by streaming aligned appends.

Every row is a leaf: the SHA-256 of its fields, each with its length before it. A source's leaves, in ascending order of
doc_id, form a tree of runs of 16; the sources' roots form one more tree of the same shape. All digests are lowercase hex, and
a node is the digest of its children's hex texts.

Leaves are dealt to aligned blocks of 16^3 positions. A task streams a block's leaves into a frontier of open
subtrees. A subtree carries the partial witness of all its leaves; when the last sibling of a run comes (or the
block ends), every member's witness is extended by its siblings and the run's root becomes one more append, a level
higher. Block roots are then the appends of the next level of blocks, until every source is one
block. No task holds more than one block; the driver sees only the length of the longest tree.

A leaf's full witness is never stored: the block's own witness is joined to the block, and the task that holds both
finishes, folds and hashes the witnesses of its leaves.

Edge cases: a null field counts as ``-`` (the empty text as ``0:``); a null doc_id comes first, a row without doc_id is
never tampered with; a null source is a source of its own, the first; rows that share a doc_id are ordered by their
leaves' digests, and rows repeated in full are leaves of their own; very long texts are hashed in the JVM and
never shuffled; a single leaf is its own subroot, a single source's subroot the root; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import ship, stage

RUN = 16     # children of a node
LEVELS = 3   # levels of a block; any number gives the same rows
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Step = tuple[str, str]  # the siblings to the left and to the right, end to end


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


class Subtree:
    """A node; ``siblings`` and ``parent`` are the step by which its leaves' witnesses were extended last."""

    __slots__ = ("root", "siblings", "parent")

    def __init__(self, root: str):
        self.root, self.siblings, self.parent = root, None, None

    def witness(self) -> list[Step]:
        out, node = [], self
        while node.parent is not None:
            out.append(node.siblings)
            node = node.parent
        return out


class Frontier:
    """The open subtrees of a tree that is being appended to: at every height those that still wait for siblings."""

    def __init__(self):
        self.open: list[list[Subtree]] = [[]]
        self.seen = [0]  # nodes of each height so far

    def append(self, node: Subtree, height: int = 0) -> None:
        if height == len(self.open):
            self.open.append([])
            self.seen.append(0)
        self.open[height].append(node)
        self.seen[height] += 1
        if len(self.open[height]) == RUN:
            self._complete(height)

    def _complete(self, height: int) -> None:
        run, self.open[height] = self.open[height], []
        parent = Subtree(digest("".join(node.root for node in run)))
        for i, node in enumerate(run):
            node.siblings = ("".join(x.root for x in run[:i]), "".join(x.root for x in run[i + 1:]))
            node.parent = parent
        self.append(parent, height + 1)

    def close(self, levels: int | None) -> str:
        """Complete what is open: up to ``levels`` in a block of a longer tree, else until one node remains."""
        height = 0
        while height < levels if levels is not None else self.seen[height] > 1:
            if self.open[height]:
                self._complete(height)
            height += 1
        return self.open[height][0].root


def grow(nodes: Iterable[str], whole: bool, levels: int) -> tuple[list[Subtree], str]:
    """(leaves with their witnesses, root) of a block of ``levels`` levels; ``whole``: it is all of its tree."""
    frontier, leaves = Frontier(), []
    for node in nodes:
        leaves.append(Subtree(node))
        frontier.append(leaves[-1])
    return leaves, frontier.close(None if whole else levels)


def fold(node: str, witness: Iterable[Step]) -> str:
    """The root that a leaf and its witness lead to."""
    for left, right in witness:
        node = digest(left + node + right)
    return node


def field(column: str, value: Column | None = None) -> Column:
    text = (F.col(column) if value is None else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column | None = None) -> Column:
    """The leaf of a row, with another text if one is given."""
    fields = [field(c, text if c == "text" else None) for c in FIELDS]
    return F.sha2(F.concat(*fields).cast("binary"), 256)


def numbered(df: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``pos``: the position of each row within its ``tree`` (nulls are one tree) in the given order.

    A range partitioning and its parts' sizes; rows alike in all these columns are dealt to several parts, too.
    """
    dealt = df.withColumn("salt", F.monotonically_increasing_id())
    dealt = (dealt.repartitionByRange(tree, *order, "salt").drop("salt").sortWithinPartitions(tree, *order)
             .withColumn("part", F.spark_partition_id()).withColumn("m", F.monotonically_increasing_id()))
    dealt = stage(dealt, name)
    parts = dealt.groupBy("part", tree).agg(F.count("*").alias("n"), F.min("m").alias("first"))
    before = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("p"), F.col(tree).alias("t"), "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    joined = dealt.join(parts, (dealt["part"] == parts["p"]) & dealt[tree].eqNullSafe(parts["t"]))
    return joined.withColumn("pos", F.col("base") + F.col("m") - F.col("first")).drop("part", "m", "p", "t", "first", "base")


def in_blocks(nodes: DataFrame, columns: list[str], levels: int, name: str) -> DataFrame:
    """(tree, block, whole, rows): rows are structs (pos, columns) in order, at most RUN ** levels of them."""
    blocks = (nodes.groupBy("tree", F.call_function("div", "pos", F.lit(RUN ** levels)).alias("block"))
              .agg(F.sort_array(F.collect_list(F.struct("pos", *columns))).alias("rows")))
    blocks = stage(blocks, name)
    last = stage(blocks.groupBy("tree").agg(F.max("block").alias("last")).withColumnRenamed("tree", "t"), f"{name}-last")
    return blocks.join(last, blocks["tree"].eqNullSafe(last["t"])).select("tree", "block", (F.col("last") == 0).alias("whole"), "rows")


STEPS = "array<struct<left string, right string>>"
STEP_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def block_roots(blocks: DataFrame, tree_type: str, levels: int) -> DataFrame:
    """(tree, pos, node, whole) of every block: the appends of the next level."""

    def run(batches):
        for batch in batches:
            whole = batch.column(2).to_pylist()
            roots = [grow(nodes, w, levels)[1] for nodes, w in zip(batch.column(3).to_pylist(), whole, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(roots, pa.string()), batch.column(2)], ["tree", "pos", "node", "whole"])

    return blocks.select("tree", "block", "whole", F.expr("transform(rows, x -> x.node)").alias("nodes")).mapInArrow(
        run, f"tree {tree_type}, pos long, node string, whole boolean")


def upper_witnesses(blocks: DataFrame, tree_type: str, levels: int, name: str) -> DataFrame:
    """(tree, pos, root, steps) of every block: its tree's root and the way there from the block's root."""
    roots = stage(block_roots(blocks, tree_type, levels), f"{name}-roots")
    done = roots.filter("whole").select("tree", "pos", F.col("node").alias("root"), F.expr(f"CAST(array() AS {STEPS})").alias("steps"))
    rest = roots.filter("not whole").drop("whole")
    if rest.isEmpty():
        return done
    longer = in_blocks(rest, ["node"], levels, f"{name}-blocks")
    above = stage(upper_witnesses(longer, tree_type, levels, f"{name}-up"), f"{name}-above").toDF("t", "b", "above_root", "above_steps")

    def run(batches):
        for batch in batches:
            out = []
            for tree, whole, rows, root, steps in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                leaves, _ = grow([r["node"] for r in rows], whole, levels)
                for r, leaf in zip(rows, leaves, strict=True):
                    own = [{"left": left, "right": right} for left, right in leaf.witness()]
                    out.append((tree, r["pos"], root, own + steps))
                    if len(out) == 1024:
                        yield _witness_rows(out, batch.schema.field(0).type)
                        out = []
            yield _witness_rows(out, batch.schema.field(0).type)

    joined = longer.join(above, longer["tree"].eqNullSafe(above["t"]) & (longer["block"] == above["b"]))
    return done.unionByName(joined.select("tree", "whole", "rows", "above_root", "above_steps").mapInArrow(
        run, f"tree {tree_type}, pos long, root string, steps {STEPS}"))


def _witness_rows(rows: list[tuple], tree_type: pa.DataType) -> pa.RecordBatch:
    columns = [[r[i] for r in rows] for i in range(4)]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], tree_type), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()),
                                       pa.array(columns[3], STEP_TYPE)], ["tree", "pos", "root", "steps"])


def tree_of(nodes: DataFrame, columns: list[str], tree_type: str, levels: int, name: str) -> DataFrame:
    """Blocks of numbered nodes (tree, pos, node, columns) with the root of their tree and the block's steps to it."""
    blocks = in_blocks(nodes, ["node", *columns], levels, f"{name}-leaves")
    above = stage(upper_witnesses(blocks, tree_type, levels, name), f"{name}-witness").toDF("t", "b", "root", "steps")
    return blocks.join(above, blocks["tree"].eqNullSafe(above["t"]) & (blocks["block"] == above["b"])).drop("t", "b")


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, source: one row per row of ``docs``.

    ``tampered``: the text that is found at checking time, by default the text itself; ``folded_root`` is recomputed from
    it and the original witness.
    """
    ship(docs.sparkSession)
    found = leaf_of(tampered) if tampered is not None else F.lit(None).cast("string")
    leaves = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("tree"), leaf_of().alias("node"), found.alias("found"))
    leaves = leaves.withColumn("found", F.nullif("found", "node"))
    blocks = tree_of(numbered(leaves, "tree", ["doc_id", "node"], "merkle-order"), ["doc_id", "found"], "string", levels, "merkle")

    subroots = blocks.groupBy("tree").agg(F.first("root").alias("node")).withColumn("all", F.lit(0)).withColumnRenamed("tree", "source")
    subroots = numbered(subroots, "all", ["source"], "merkle-sources").withColumnRenamed("all", "tree")
    top = tree_of(subroots, ["source"], "int", levels, "merkle-top")
    top = stage(top.mapInArrow(_source_steps(levels), f"source string, root string, steps {STEPS}"), "merkle-top-witness").toDF("of", "top_root", "top_steps")

    joined = blocks.join(top, blocks["tree"].eqNullSafe(top["of"]))
    return (joined.select("tree", "whole", "rows", "root", "steps", "top_root", "top_steps")
            .mapInArrow(_proofs(levels), "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, source string"))


def _source_steps(levels: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                leaves, _ = grow([x["node"] for x in r["rows"]], r["whole"], levels)
                for x, leaf in zip(r["rows"], leaves, strict=True):
                    out.append((x["source"], r["root"], [{"left": a, "right": b} for a, b in leaf.witness()] + r["steps"]))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string()),
                                              pa.array([x[2] for x in out], STEP_TYPE)], ["source", "root", "steps"])

    return run


def _proofs(levels: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree, whole, rows, subroot, steps, root, top = (c[i].as_py() for c in batch.columns)
                above = [(s["left"], s["right"]) for s in steps + top]
                beyond = "".join(left + right for left, right in above)
                leaves, _ = grow([r["node"] for r in rows], whole, levels)
                proofs, folded = [], []
                for r, leaf in zip(rows, leaves, strict=True):
                    own = leaf.witness()
                    proofs.append(digest("".join(left + right for left, right in own) + beyond))
                    folded.append(fold(r["found"] or r["node"], own + above))
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["doc_id"] for r in rows], pa.int64()), pa.array([r["node"] for r in rows], pa.string()), pa.array([subroot] * n, pa.string()),
                     pa.array([root] * n, pa.string()), pa.array(proofs, pa.string()), pa.array(folded, pa.string()), pa.array([f == root for f in folded], pa.bool_()),
                     pa.array([tree] * n, pa.string())],
                    ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "source"])

    return run


def crc32_sql(text: str) -> str:
    """DuckDB: the unsigned crc32 of an ASCII text."""
    byte = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(3988292384::BIGINT, x >> 1) ELSE x >> 1 END)"
    codes = f"list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)"
    # a step takes the low byte of c with b into eight shifts; xor of the whole c with b is the same, as b has eight bits
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295::BIGINT)"


def oracle(levels: int = 4, top_levels: int = 2) -> str:
    """DuckDB SQL for trees of up to 16^levels leaves a source and 16^top_levels sources, by levels."""

    def fields(text: str) -> str:
        parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in FIELDS[:-1]]
        return "sha256(" + " || ".join([*parts, f"coalesce(strlen({text}) || ':' || {text}, '-')"]) + ")"

    tampered = f"CASE WHEN doc_id IS NOT NULL AND {crc32_sql('doc_id::VARCHAR')} % 5 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END"
    sql = [f"rows_ AS (SELECT doc_id, source, {fields('text')} AS leaf, {fields('found')} AS found FROM (SELECT *, {tampered} AS found FROM documents))",
           "l0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, 0 AS t, '' AS proof, found AS folded FROM rows_)",
           "n0 AS (SELECT source AS tree, pos, leaf AS node FROM l0)"]

    def climb(k: int, tree: str, n: int) -> None:
        for i in range(k, k + n):
            sql.append(f"c{i} AS (SELECT tree, count(*) AS n FROM n{i} GROUP BY tree)")
            sql.append(f"n{i + 1} AS (SELECT n{i}.tree, CASE WHEN n > 1 THEN pos // 16 ELSE pos END AS pos, "
                       f"CASE WHEN any_value(n) > 1 THEN sha256(string_agg(node, '' ORDER BY n{i}.pos)) ELSE any_value(node) END AS node "
                       f"FROM n{i} JOIN c{i} ON n{i}.tree IS NOT DISTINCT FROM c{i}.tree GROUP BY 1, 2)")
            sides = (f"SELECT l.doc_id, l.leaf, l.pos, l.{tree}, coalesce(string_agg(n{i}.node, '' ORDER BY n{i}.pos) FILTER (n{i}.pos < l.pos), '') AS a, "
                     f"coalesce(string_agg(n{i}.node, '' ORDER BY n{i}.pos) FILTER (n{i}.pos > l.pos), '') AS b, any_value(c{i}.n) AS n "
                     f"FROM (SELECT DISTINCT doc_id, leaf, pos, {tree} FROM l{i}) l JOIN n{i} ON n{i}.tree IS NOT DISTINCT FROM l.{tree} AND n{i}.pos // 16 = l.pos // 16 "
                     f"JOIN c{i} ON c{i}.tree IS NOT DISTINCT FROM l.{tree} GROUP BY ALL")
            sql.append(f"l{i + 1} AS (SELECT l{i}.* REPLACE (CASE WHEN n > 1 THEN l{i}.pos // 16 ELSE l{i}.pos END AS pos, proof || a || b AS proof, "
                       f"CASE WHEN n > 1 THEN sha256(a || folded || b) ELSE folded END AS folded) "
                       f"FROM l{i} JOIN ({sides}) s ON s.doc_id IS NOT DISTINCT FROM l{i}.doc_id AND s.leaf = l{i}.leaf AND s.pos = l{i}.pos AND s.{tree} IS NOT DISTINCT FROM l{i}.{tree})")

    climb(0, "source", levels)
    k = levels
    sql.append(f"roots AS (SELECT tree AS source, node AS subroot, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos FROM n{k})")
    sql.append(f"l{k + 1} AS (SELECT l{k}.* REPLACE (roots.pos AS pos), subroot FROM l{k} JOIN roots ON roots.source IS NOT DISTINCT FROM l{k}.source)")
    sql.append(f"n{k + 1} AS (SELECT 0 AS tree, pos, subroot AS node FROM roots)")
    climb(k + 1, "t", top_levels)
    last = k + 1 + top_levels
    return ("WITH " + ",\n".join(sql) + f"""
SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = node AS verified, source
FROM l{last} CROSS JOIN n{last}""")


def lower_some(step: int = 5) -> Column:
    """The text with A-Z lower-cased where ``step`` divides the crc32 of the doc_id's decimals, else as it is."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % step == 0
    return F.when(F.coalesce(hit, F.lit(False)), F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
