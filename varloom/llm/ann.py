"""Approximate nearest neighbours by inner product: balanced posting lists.

Vectors are put into lists around centroids. A vector near a border goes to
several lists (those whose centroid is almost as near as the nearest one and not
sheltered by a chosen centroid). The centroids sit in memory in a neighbour graph that
is searched best-first; a query reads the lists whose centroid lies within a
ratio of the nearest distance, and as many more as it takes to have seen ``least`` vectors.

Inner products become distances by one more coordinate, ``sqrt(max norm^2 - norm^2)``,
so vectors of any length can be indexed. Centroids come from a bounded sample
(``SAMPLE`` distinct vectors, or ``PER_LIST`` for each list where that is more; smallest by a hash of the id); every
row is indexed. There are n / ``LIST`` lists up to ``FLAT``, then as many as the root of n, at most ``MAX_LISTS``, so list and
number of lists grow alike; beyond ``FLAT`` they are clustered in two levels. Equal vectors are one entry that keeps the k + 1 smallest ids: no more can
be among the k nearest, ties going to the smaller id. A long list is
dealt into blocks, and so are the queries that read it, so a task holds two bounded blocks. What the blocks find
is cut to the best rows of each query before it is shuffled.

Edge cases: null vectors, null or non-finite components and zero vectors take no part,
nor do vectors whose dimension is not the commonest one; rows that repeat both id and vector are one row, those that share only the id
are rows of their own: each is a query with ranks of its own, and a candidate of the others; with fewer than k
candidates all are returned; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import ship, stage

SAMPLE, PER_LIST, LIST = 1 << 14, 16, 64
FLAT, MAX_LISTS = 1 << 11, 1 << 16
BLOCK, QUERY_BLOCK = 2048, 2048
REPLICAS, CLOSURE = 6, 1.15      # lists of a vector at most; how much farther a further list may be
RATIO, LEAST, BEAM = 1.25, 2000, 128  # distance ratio for queries, vectors seen at least, beam of the graph search
DEGREE = 24


@dataclass
class Centroids:
    points: np.ndarray   # augmented, float32
    graph: np.ndarray    # neighbours of each centroid
    entries: np.ndarray  # where a search begins

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, squared distances) of the nearest centroids found, nearest first; best-first over the graph, for all rows at once."""
        n, beam = len(x), min(beam, len(self.points))
        square = (self.points**2).sum(1)
        own = (x**2).sum(1)
        rows = np.arange(n)
        seen = np.zeros((n, len(self.points)), bool)
        ids = np.tile(self.entries, (n, 1))
        seen[:, self.entries] = True
        dist = own[:, None] + square[ids] - 2 * x @ self.points[self.entries].T
        done = np.zeros(ids.shape, bool)
        while True:
            waiting = np.where(done, np.inf, dist)
            best = waiting.argmin(1)
            active = np.isfinite(waiting[rows, best])
            if not active.any():
                break
            done[rows, best] = True
            near = self.graph[ids[rows, best]]
            fresh = ~seen[rows[:, None], near] & active[:, None]
            seen[rows[:, None], near] = True
            d = own[:, None] + square[near] - 2 * np.einsum("nd,nkd->nk", x, self.points[near])
            ids = np.concatenate([ids, near], 1)
            dist = np.concatenate([dist, np.where(fresh, d, np.inf)], 1)
            done = np.concatenate([done, ~fresh], 1)
            keep = np.argsort(dist, 1, kind="stable")[:, :beam]
            ids, dist, done = (np.take_along_axis(t, keep, 1) for t in (ids, dist, done))
        return ids, np.maximum(dist, 0)


def _nearest(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[None]
    return np.concatenate([(square - 2 * x[at:at + 4096] @ points.T).argmin(1) for at in range(0, max(len(x), 1), 4096)])


def cluster(x: np.ndarray, n_lists: int, turns: int = 12) -> np.ndarray:
    """Balanced centroids: k-means in which crowded clusters are split in place of the emptiest ones."""
    rng = np.random.default_rng(7)
    points = x[rng.permutation(len(x))[:n_lists]].copy()
    for turn in range(turns):
        own = _nearest(x, points)
        size = np.bincount(own, minlength=len(points))
        total = np.zeros_like(points)
        np.add.at(total, own, x)
        points = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], points).astype(x.dtype)
        if turn < turns - 3:
            crowded = np.argsort(-size)[:max(1, len(points) // 16)]
            empty = np.argsort(size)[:len(crowded)]
            for big, small in zip(crowded, empty, strict=True):
                if size[big] > 2 * max(size[small], 1) and size[big] > 2 * len(x) / len(points):
                    members = x[own == big]
                    points[small] = members[rng.integers(len(members))]
    return points


def list_count(n: int) -> int:
    """How many lists n vectors are put into."""
    return min(-(-n // LIST), max(FLAT, math.isqrt(n)), MAX_LISTS)


def two_levels(x: np.ndarray, n_lists: int) -> np.ndarray:
    """Centroids of coarse clusters' members, as many of each cluster as its share of ``x``."""
    coarse = cluster(x, math.isqrt(n_lists))
    own = _nearest(x, coarse)
    parts = [x[own == c] for c in range(len(coarse))]
    return np.concatenate([cluster(p, min(len(p), max(1, round(n_lists * len(p) / len(x))))) for p in parts if len(p)])


def make_centroids(sample: np.ndarray, n_lists: int) -> Centroids:
    points = cluster(sample, min(n_lists, len(sample))) if n_lists <= FLAT else two_levels(sample, n_lists)
    degree = min(DEGREE, max(len(points) - 1, 1))
    square, near = (points**2).sum(1)[None], []
    for at in range(0, len(points), 1024):
        d = square - 2 * points[at:at + 1024] @ points.T
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        some = np.argpartition(d, degree - 1, 1)[:, :degree]
        near.append(np.take_along_axis(some, np.argsort(np.take_along_axis(d, some, 1), 1, kind="stable"), 1))
    graph = np.concatenate(near)
    rng = np.random.default_rng(11)
    if len(points) > degree:  # a few far links keep the graph connected
        graph = np.concatenate([graph, rng.integers(0, len(points), (len(points), 4)), np.roll(np.arange(len(points)), 1)[:, None]], 1)
    return Centroids(points, graph, rng.permutation(len(points))[:16])


def _matrix(column: pa.ChunkedArray | pa.Array, dtype=np.float32) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


def _augmented(x: np.ndarray, top: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(top - (x.astype(np.float64) ** 2).sum(1), 0))
    return np.concatenate([x, rest[:, None].astype(np.float32)], 1)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.filter("vec_id is not null and embedding is not null").filter((F.size("embedding") > 0) & finite)
    v = v.filter(F.exists("embedding", lambda x: x != 0))
    dim = v.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return v.filter(F.size("embedding") == (dim["d"] if dim else 0))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query row, the row itself left out.

    ``vectors``: (vec_id, embedding); ``queries``: rows of it, (vec_id, embedding).
    """
    spark = vectors.sparkSession
    ship(spark)
    vectors = usable(vectors)
    rows, different = vectors.agg(F.count("*"), F.count_distinct("vec_id")).first()
    unique = rows == different
    if not unique:  # rows repeated in full are one
        vectors = vectors.distinct()
    same = Window.partitionBy("h", "embedding").orderBy("vec_id")
    entries = (vectors.withColumn("h", F.xxhash64("embedding")).withColumn("r", F.row_number().over(same)).filter(F.col("r") <= k + 1)
               .groupBy("h", "embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("entry", F.element_at("ids", 1)))
    if not unique:  # the smallest id may name two entries: number them in its order
        entries = entries.repartitionByRange("entry", "h").sortWithinPartitions("entry", "h").withColumn("entry", F.monotonically_increasing_id())
    entries = stage(entries, "ann-entries")
    size = entries.agg(F.count("*").alias("n"), F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("top")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not size["n"]:
        return spark.createDataFrame([], schema)
    top = size["top"]
    n_lists = list_count(size["n"])
    some = max(SAMPLE, PER_LIST * n_lists if n_lists > FLAT else 0)
    sample = entries.orderBy(F.xxhash64("entry"), "entry").limit(some).select("embedding").toArrow()
    centroids = make_centroids(_augmented(_matrix(sample["embedding"]), top), n_lists)
    shared = spark.sparkContext.broadcast(centroids)

    def lists_of(batches):
        c = shared.value
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                x = _augmented(_matrix(part.column(1)), top)
                ids, dist = c.search(x, 32)
                chosen = np.zeros(ids.shape, bool)
                chosen[:, 0] = True
                for j in range(1, ids.shape[1]):  # near enough, and nearer to the vector than to every chosen centroid
                    ok = (dist[:, j] <= CLOSURE**2 * dist[:, 0] + 1e-12) & (chosen.sum(1) < REPLICAS)
                    if not ok.any():
                        break
                    for i in range(j):
                        apart = ((c.points[ids[:, i]] - c.points[ids[:, j]]) ** 2).sum(1)
                        ok &= ~(chosen[:, i] & (apart < 0.25 * dist[:, j]))
                    chosen[:, j] = ok
                row, col = np.nonzero(chosen)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(ids[row, col].astype(np.int32))], ["entry", "list"])

    where = stage(entries.select("entry", "embedding").mapInArrow(lists_of, "entry long, list int"), "ann-lists")
    sizes = np.zeros(len(centroids.points), np.int64)
    for r in where.groupBy("list").agg(F.count("*").alias("n")).collect():  # at most MAX_LISTS rows
        sizes[r["list"]] = r["n"]

    asked = (usable_queries(queries, vectors).withColumn("h", F.xxhash64("embedding"))
             .join(entries.select("h", "embedding", "entry"), ["h", "embedding"]).select("query_id", "entry"))
    asked = stage(asked, "ann-asked")
    distinct = entries.join(asked.select("entry").distinct(), "entry", "left_semi").select("entry", "embedding")
    sizes_shared = spark.sparkContext.broadcast(sizes)

    def lists_read(batches):
        c, sizes = shared.value, sizes_shared.value
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                x = _matrix(part.column(1))
                ids, dist = c.search(np.concatenate([x, np.zeros((len(x), 1), np.float32)], 1), BEAM)
                # all vectors of the largest norm lie sqrt(top - |q|^2...) away at least: compare what is beyond that
                floor = np.maximum((x.astype(np.float64) ** 2).sum(1) + top - 2 * np.sqrt((x.astype(np.float64) ** 2).sum(1) * top), 0)[:, None]
                away = np.sqrt(np.maximum(dist - floor, 0))
                before = np.cumsum(sizes[ids], 1) - sizes[ids]
                take = (away <= RATIO * away[:, :1]) | (before < LEAST)
                row, col = np.nonzero(take & np.isfinite(dist))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(ids[row, col].astype(np.int32))], ["query", "list"])

    reads = stage(distinct.mapInArrow(lists_read, "query long, list int"), "ann-reads")
    per_list = (where.groupBy("list").agg(F.count("*").alias("n"))
                .join(reads.groupBy("list").agg(F.count("*").alias("q")), "list")
                .select("list", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("q") / QUERY_BLOCK).cast("int").alias("qblocks")))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    postings = (where.join(F.broadcast(per_list), "list").withColumn("block", F.pmod(F.xxhash64("entry"), "blocks").cast("int"))
                .withColumn("qblock", spread("qblocks")).join(entries.select("entry", F.col("embedding").alias("vector")), "entry"))
    asking = (reads.join(F.broadcast(per_list), "list").withColumn("qblock", F.pmod(F.xxhash64("query"), "qblocks").cast("int"))
              .withColumn("block", spread("blocks")).join(entries.select(F.col("entry").alias("query"), "embedding"), "query"))

    def scan(q: pa.Table, p: pa.Table) -> pa.Table:
        none = pa.table({"query": pa.array([], pa.int64()), "entry": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not len(q) or not len(p):
            return none
        a, b = _matrix(q["embedding"], np.float64), _matrix(p["vector"], np.float64)
        s = a @ b.T
        m = min(k + 1, len(b))
        best = np.argpartition(-s, m - 1, 1)[:, :m]
        cut = np.take_along_axis(s, best, 1).min(1)[:, None]
        row, col = np.nonzero(s >= cut - 1e-12 * np.abs(cut))  # ties stay
        score = np.zeros(len(row))
        for d in range(a.shape[1]):  # in the order of the components, so equal vectors score equally everywhere
            score += a[row, d] * b[col, d]
        return pa.table({"query": q["query"].to_numpy()[row], "entry": p["entry"].to_numpy()[col], "score": score})

    key = ["list", "block", "qblock"]
    found = (asking.select(*key, "query", "embedding").groupBy(*key).cogroup(postings.select(*key, "entry", "vector").groupBy(*key))
             .applyInArrow(scan, "query long, entry long, score double"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    # a replicated vector is met up to REPLICAS times, so this many rows hold the k + 1 best; every task cuts its own before the shuffle
    found = found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= (k + 1) * REPLICAS).drop("r")
    found = (found.groupBy("query", "entry").agg(F.max("score").alias("score"))
             .withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).drop("r"))
    found = stage(found.join(entries.select("entry", "ids"), "entry"), "ann-found")
    rank = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (asked.withColumnRenamed("entry", "query").join(found, "query")
            .select("query_id", "query", "entry", "score", F.explode("ids").alias("vec_id"))
            .filter("vec_id <> query_id or entry <> query")
            .withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def usable_queries(queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """(query_id, embedding) of the query rows that take part."""
    ids = queries.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    return vectors.join(ids, "vec_id", "left_semi").select(F.col("vec_id").alias("query_id"), "embedding")
