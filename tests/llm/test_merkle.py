"""Merkle manifest against trees built level by level in plain Python, and against its SQL."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from varloom.llm import merkle
from varloom.session import work_dir

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, text):
    values = [r.doc_id, r.source, r.lang, r.n_chars, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 16 * 16
        out.append(("".join(level[run:i]), "".join(level[i + 1:run + 16])))
        i //= 16
    return out


def expected(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        sources[s].sort(key=lambda x: x[:3])
        trees.append(tree([x[2] for x in sources[s]]))
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, digest, r) in enumerate(sources[s]):
            steps = path(trees[k], i) + path(top, k)
            node = digest
            if r.doc_id is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
                node = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text))
            for left, right in steps:
                node = sha(left + node + right)
            out.append((r.doc_id, digest, trees[k][-1][0], top[-1][0], sha("".join(a + b for a, b in steps)), node, node == top[-1][0]))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is not None, str(x)) for x in r])


def found(df, **kwargs):
    return [tuple(r) for r in merkle.manifest(df, merkle.lower_some(), **kwargs).select(COLUMNS).collect()]


@pytest.fixture(scope="module")
def many(spark):
    """Null and shared ids, repeated rows, null fields, over 16 sources and a hot one, clashing names."""
    df = spark.range(6000).selectExpr(
        "IF(id % 100 = 3, NULL, id DIV 2) AS doc_id", "IF(id % 1000 = 5, NULL, IF(id < 5000, 'aB', concat('Text É ', id))) AS text",
        "IF(id % 7 = 0, NULL, 'en') AS lang", "IF(id % 3 = 0 OR id > 5900, concat('S', id % 300), IF(id % 2 = 0, NULL, 'x')) AS source", "IF(id % 5 = 0, NULL, id) AS n_chars")
    for c in ("tree", "node", "pos", "found", "root", "block", "part", "m", "steps", "leaf"):
        df = df.withColumn(c, F.lit(c))
    return df


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_equals_trees_built_by_level(many, levels):
    rows = many.collect()
    assert ordered(found(many, levels=levels)) == ordered(expected(rows))


def test_equals_sql(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    df = df.union(df.limit(3)).union(df.limit(2).withColumn("doc_id", F.lit(None).cast("long"))).union(df.limit(1).withColumn("text", F.lit(None)))
    folder = work_dir(spark, "test-merkle").removeprefix("file:")
    df.write.parquet(folder)
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/*.parquet'")
    got = found(spark.read.parquet(folder))
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)
    assert ordered(got) == ordered(expected(df.collect()))
    assert set(got) == set(c.sql(f"SELECT {', '.join(COLUMNS)} FROM ({merkle.oracle()})").fetchall())


def test_untouched_rows_verify(many):
    assert merkle.manifest(many).filter("not verified or folded_root <> root").count() == 0


def test_no_row_one_row(spark, many):
    assert found(many.limit(0)) == []
    one = many.filter("doc_id = 10").limit(1)
    (row,) = found(one)
    assert row[1] == row[2] == row[3] and row[4] == sha("")


def test_frontier_extends_witnesses_as_siblings_come():
    leaves = [sha(str(i)) for i in range(300)]
    frontier, nodes = merkle.Frontier(), []
    for i, digest in enumerate(leaves):
        nodes.append(merkle.Subtree(digest))
        frontier.append(nodes[-1])
        # complete runs have their step, open ones none
        assert all(len(n.witness()) >= 1 for n in nodes[:(i + 1) // 16 * 16]) and not any(n.witness() for n in nodes[(i + 1) // 16 * 16:])
    root = frontier.close(None)
    levels = tree(leaves)
    assert root == levels[-1][0]
    assert all(n.witness() == path(levels, i) and merkle.fold(n.root, n.witness()) == root for i, n in enumerate(nodes))
