"""Line dedup: exact set-similarity join of lines; later matches are removed.

A line is what stands between newlines; its tokens are its distinct 5-word shingles
(the whole sequence as one where it has fewer words). Tokens are ordered by
rarity. A line goes when an earlier line (smaller doc_id, or higher up in the
same document) has a Jaccard similarity of 3/4 or more with it, whether or not that line goes
itself; blank lines stay and match nothing.

Equal sets are collapsed to their first line. The rest is a prefix join:
postings of the rarest tokens, one shuffle by bucket of tokens. Lines and postings go through it packed, a row for
each bucket that a task has something for; buckets grow in number with the tokens of the table, and a token of very many
sets is not held by the task of its bucket. Where the lists that are left are long, star rounds test every
line against the first line of each (token, length band), which settles most
of a large family of near copies with a linear number of pairs; all pairs of a line that is still
unsettled with earlier lines are then enumerated, with the length
filter, the number of prefix tokens that such a pair must share, the
positional filter and the parity bits of the sets, and verified on the whole sets. No pair of a settled line
is made, and nothing is left out.

Edge cases: a null text counts as empty (one blank line); repeated rows with one
doc_id are taken as one document if equal, else as documents of their own in the order of their texts' hashes; a null
doc_id is an id like any other and the smallest; a very long text is a block of its own; an empty table gives an empty result; further columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varloom.llm.common import FEW, bloom, bloom_hits, held, id_text, only_ids, row_keyed
from varloom.llm.hashing import CHUNK, U, block_words, fmix_sum, shingles
from varloom.llm.prefix_sets import I64, bits_agree, counted_tokens, may_match, shared_enough

K = 5
STAR_ROUNDS, OPEN = 6, 16


def line_tokens(data: bytes, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """(line, token) of every shingle of a block of lines, in order; blank lines have none."""
    h, at = block_words(data)
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    line = np.searchsorted(breaks, at)
    n = len(h)
    out_line, out = [], []
    if n >= k:
        whole = np.flatnonzero(line[k - 1:] == line[:n - k + 1])
        out_line.append(line[whole])
        out.append(shingles(h, k)[whole])
    first = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if n else np.zeros(0, int)
    count = np.diff(np.append(first, n))
    for w in range(1, k):  # lines of fewer words, as a whole
        short = first[count == w]
        if len(short):
            out_line.append(line[short])
            out.append(shingles(h, w)[short])
    if not out:
        return np.zeros(0, I64), np.zeros(0, U)
    return np.concatenate(out_line), np.concatenate(out)


class Blocks:
    """Joins short documents to blocks of about CHUNK bytes; a longer document is a block of its own."""

    def __init__(self, batches):
        self.batches = batches

    def __iter__(self):
        """(ids, first line of each id's document in the block, bytes)"""
        ids, starts, parts, size, lines = [], [], [], 0, 0
        for batch in self.batches:
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = data.as_py()
                if size and size + len(data) > CHUNK:
                    yield ids, starts, b"\n".join(parts)
                    ids, starts, parts, size, lines = [], [], [], 0, 0
                ids.append(doc)
                starts.append(lines)
                parts.append(data)
                lines += data.count(b"\n") + 1
                size += len(data) + 1
        if ids:
            yield ids, starts, b"\n".join(parts)


def _sorted_sets(line, token, rank=None):
    """Distinct tokens by line, in the global order: (line, token, first row of each line)."""
    # line, whether listed, rank or hash in one number; sorted as three where that is cut too short to tell two tokens apart
    bits = U(int(line.max()).bit_length())
    code = token >> U(1)
    if rank is not None:
        code = np.where(rank > 0, U(1 << 63) | (rank.astype(U) << U(46)), code)
    code = (line.astype(U) << (U(64) - bits)) | (code >> bits) if bits else code
    order = np.argsort(code)
    code, sorted_ = code[order], token[order]
    if ((code[1:] == code[:-1]) & (sorted_[1:] != sorted_[:-1])).any():
        order = np.lexsort((token, line) if rank is None else (token, rank, line))
        sorted_ = token[order]
    line, token = line[order], sorted_
    keep = np.ones(len(line), bool)
    keep[1:] = (line[1:] != line[:-1]) | (token[1:] != token[:-1])
    line, token = line[keep], token[keep]
    return line, token, np.flatnonzero(np.append(True, line[1:] != line[:-1]))


def _listed(table):
    """Which values of the first 20 bits the table's tokens have: few others need to be looked up."""
    out = np.zeros(1 << 20, bool)
    out[(table[0] >> U(44)).astype(I64)] = True
    return out


def _ranks(token, table, listed):
    keys, rank = table
    out = np.zeros(len(token), I64)
    maybe = np.flatnonzero(listed[(token >> U(44)).astype(I64)])
    if len(maybe):
        at = np.searchsorted(keys, token[maybe])
        at[at == len(keys)] = 0
        out[maybe] = np.where(keys[at] == token[maybe], rank[at] + 1, 0)
    return out


PACKED = "bucket int, kind int, data binary"
SET, POSTING, HOT_POSTING, GONE = range(4)
FIELDS = {SET: 6, POSTING: 3}  # of eight bytes: (key, second hash, size, doc, line, parity bits), (token, key, size << 32 | position)
HELD, FLUSH = 1 << 21, 1 << 18
BUCKETS, TOKENS = 1 << 10, 1 << 22  # at least so many buckets, and in larger tables one for so many tokens


def _packed(kind: int, columns: list, buckets: int) -> pa.RecordBatch:
    """A row for every bucket of the first column's hashes, with the columns' values there."""
    table = np.stack([c.view(I64) for c in columns])
    bucket = (table[0].view(U) % U(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket, table = bucket[order].astype(np.int32), table[:, order]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    data = [table[:, i:j].tobytes() for i, j in zip(cuts, np.append(cuts[1:], len(bucket)), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[cuts]), pa.array(np.full(len(cuts), kind, np.int32)), pa.array(data, pa.binary())], ["bucket", "kind", "data"])


def _rows(docs: DataFrame, table, buckets: int) -> DataFrame:
    """Every line's set and once per set and task its prefix, packed by bucket."""

    def scan(batches):
        ranks, seen = table.value, set()
        listed = _listed(ranks)
        lines, posts, n_lines, n_posts = [], [], 0, 0
        for ids, starts, data in Blocks(batches):
            line, token = line_tokens(data)
            if not len(line):
                continue
            line, token, first = _sorted_sets(line, token, _ranks(token, ranks, listed))
            size = np.diff(np.append(first, len(line)))
            a, b = fmix_sum(token, first)
            parity = np.bitwise_xor.reduceat(U(1) << (token >> U(58)), first)
            owner = np.searchsorted(starts, line[first], side="right") - 1
            doc, number = np.array(ids, I64)[owner], line[first] - np.array(starts, I64)[owner]
            lines.append([x.view(I64) for x in (a, b, size.astype(I64), doc, number.astype(I64), parity)])
            n_lines += len(a)
            new = np.array([not (x in seen or seen.add(x)) for x in a.tolist()])
            # size - ceil(3 size / 4) + 1; a set of one or two only matches an equal one, and those are collapsed
            length = np.where(new & (size > 2), size + (-3 * size // 4) + 1, 0)
            place = np.arange(len(line)) - np.repeat(first, size)
            mine = place < np.repeat(length, size)
            posts.append([token[mine].view(I64), np.repeat(a, length).view(I64), (np.repeat(size, length).astype(I64) << 32) | place[mine]])
            n_posts += len(posts[-1][0])
            if n_posts >= FLUSH:
                yield _packed(POSTING, [np.concatenate(c) for c in zip(*posts, strict=True)], buckets)
                posts, n_posts = [], 0
            if n_lines >= FLUSH:
                yield _packed(SET, [np.concatenate(c) for c in zip(*lines, strict=True)], buckets)
                lines, n_lines = [], 0
        for kind, parts, n in ((POSTING, posts, n_posts), (SET, lines, n_lines)):
            if n:
                yield _packed(kind, [np.concatenate(c) for c in zip(*parts, strict=True)], buckets)

    return docs.mapInArrow(scan, PACKED)


SETTLED = "kind int, token long, key long, n long, pos long, doc long, line long"


def _settled_batch(of_kind: int, **columns: np.ndarray) -> pa.RecordBatch:
    """A batch of SETTLED with the given columns; the others are null."""
    rows = len(next(iter(columns.values())))
    columns = {"kind": np.full(rows, of_kind, np.int32), **columns}
    names = [c.split()[0] for c in SETTLED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[c]) if c in columns else pa.nulls(rows, pa.int64()) for c in names], names)


class _Held:
    """What came of a bucket so far, reduced whenever it has doubled."""

    def __init__(self):
        self.parts, self.n, self.bound = [], 0, HELD

    def add(self, part: np.ndarray):
        self.parts.append(part)
        self.n += part.shape[1]
        if self.n >= self.bound:
            left = yield from self.reduce(np.concatenate(self.parts, axis=1))
            self.parts, self.n = [left], left.shape[1]
            self.bound = max(HELD, 2 * self.n)


class _Sets(_Held):
    """Distinct sets of a bucket with their first lines; all other lines are handed on as gone."""

    def reduce(self, t: np.ndarray):
        t = t[:, np.lexsort((t[4], t[3], t[2], t[1], t[0]))]
        new = np.append(True, (t[:3, 1:] != t[:3, :-1]).any(axis=0))
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        gone = (t[3:5] != t[3:5, first]).any(axis=0)  # repeated rows name the first line again
        if gone.any():
            yield _settled_batch(GONE, doc=t[3, gone], line=t[4, gone])
        return t[:, new]

    def end(self):
        t = yield from self.reduce(np.concatenate(self.parts, axis=1))
        yield _settled_batch(SET, token=t[5], key=t[0], n=t[2], doc=t[3], line=t[4])


class _Postings(_Held):
    """Postings of tokens that two or more sets have in their prefix, each once.

    A token of very many sets is not held: its postings are handed on as they come, as HOT_POSTING, and may come again.
    """

    def __init__(self):
        super().__init__()
        self.hot = np.zeros(0, I64)

    def _hand_on(self, kind: int, t: np.ndarray):
        return _settled_batch(kind, token=t[0], key=t[1], n=t[2] >> 32, pos=t[2] & 0xFFFFFFFF)

    def reduce(self, t: np.ndarray):
        t = t[:, np.lexsort((t[1], t[0]))]
        t = t[:, np.append(True, (t[:2, 1:] != t[:2, :-1]).any(axis=0))]
        tokens, counts = np.unique(t[0], return_counts=True)
        self.hot = np.union1d(self.hot, tokens[counts > HELD >> 4])
        hot = np.isin(t[0], self.hot)
        if hot.any():
            yield self._hand_on(HOT_POSTING, t[:, hot])
        return t[:, ~hot]

    def end(self):
        t = np.concatenate(self.parts, axis=1)
        if not len(self.hot):  # most tokens come once: no need to sort them by key too
            t = t[:, np.argsort(t[0])]
            same = t[0, 1:] == t[0, :-1]
            t = t[:, np.append(False, same) | np.append(same, False)]
        if t.shape[1]:
            t = yield from self.reduce(t)
        if t.shape[1]:
            new = np.append(True, t[0, 1:] != t[0, :-1])
            several = np.diff(np.append(np.flatnonzero(new), t.shape[1])) > 1
            t = t[:, several[np.cumsum(new) - 1]]
            if t.shape[1]:
                yield self._hand_on(POSTING, t)


def _settled(rows: DataFrame) -> DataFrame:
    """Distinct sets, shared postings and the lines that repeat an earlier one's set; one shuffle by bucket."""

    def settle(batches):
        at = held = None
        for batch in batches:
            for bucket, kind, data in zip(*(batch.column(j).to_pylist() for j in range(2)), batch.column(2), strict=True):
                if (bucket, kind) != at:
                    if held is not None:
                        yield from held.end()
                    at, held = (bucket, kind), _Sets() if kind == SET else _Postings()
                yield from held.add(np.frombuffer(data.as_py(), I64).reshape(FIELDS[kind], -1))
        if held is not None:
            yield from held.end()

    return rows.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(settle, SETTLED)


def _line_sets(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, line_no, set) of the given lines, possibly of a few others; no text is shuffled while the documents fit a filter."""
    wanted = bloom(lines)
    def scan(batches):
        for ids, starts, data in Blocks(batches):
            parts = data.split(b"\n")
            ends = starts[1:] + [len(parts)]
            doc = np.repeat(np.array(ids, I64), np.array(ends) - np.array(starts))
            number = np.arange(len(parts)) - np.repeat(np.array(starts, I64), np.array(ends) - np.array(starts))
            hit = np.flatnonzero(bloom_hits(wanted.value, doc, number)) if wanted is not None else np.arange(len(parts))
            if not len(hit):
                continue
            line, token = line_tokens(b"\n".join(parts[i] for i in hit))
            if not len(line):
                continue
            line, token, first = _sorted_sets(line, token)
            mine = hit[line[first]]
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(line)).astype(np.int32)), pa.array(token.view(I64)))
            yield pa.RecordBatch.from_arrays([pa.array(doc[mine]), pa.array(number[mine].astype(I64)), lists], ["doc_id", "line_no", "set"])

    sets = only_ids(docs, lines.select("doc_id").distinct()).mapInArrow(scan, "doc_id long, line_no long, set array<long>")
    return sets if wanted is not None else sets.join(lines, ["doc_id", "line_no"], "left_semi")


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Held (key, doc_id, line_no) of the later lines whose pair reaches the threshold. pairs: x, y (key, doc_id, line_no); y is earlier."""
    pairs = held(pairs)
    both = pairs.select(F.explode(F.array("x", "y")).alias("p")).select("p.doc_id", "p.line_no").distinct()
    sets = held(_line_sets(docs, held(both)))
    for side in "xy":
        pairs = pairs.join(sets.select(F.col("doc_id").alias(f"{side}_doc"), F.col("line_no").alias(f"{side}_line"), F.col("set").alias(f"s{side}")),
                           (F.col(f"{side}.doc_id") == F.col(f"{side}_doc")) & (F.col(f"{side}.line_no") == F.col(f"{side}_line")))
    i = F.size(F.array_intersect("sx", "sy")).cast("long")
    hit = pairs.filter(100 * i >= 75 * (F.size("sx") + F.size("sy") - i))
    return held(hit.select("x.*").distinct())


def _passing(pairs: DataFrame) -> DataFrame:
    """Pairs (x, y) from rows (x, nx, px, y, ny, py), one per shared prefix token that passes the filters."""
    return (pairs.groupBy("x", "y").agg(F.count("*").alias("shared"), F.first("nx").alias("nx"), F.first("ny").alias("ny"))
            .filter(shared_enough(*map(F.col, ("shared", "nx", "ny")))).select("x", "y"))


def _found(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sets, gone): the first line of every set, and the lines that go, both (doc_id, line_no); a line may be gone more than once."""
    docs = id_text(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    table, total = counted_tokens(docs, lambda batches: (line_tokens(data)[1] for _, _, data in Blocks(batches)))
    rows = held(_settled(_rows(docs, table, max(BUCKETS, total // TOKENS))))
    sets = rows.filter(F.col("kind") == SET).select("key", "n", F.col("token").alias("bits"), F.col("doc").alias("doc_id"), F.col("line").alias("line_no"))
    gone = rows.filter(F.col("kind") == GONE).select(F.col("doc").alias("doc_id"), F.col("line").alias("line_no"))

    post = rows.select("token", "key", "n", "pos")
    hot = post.filter(rows["kind"] == HOT_POSTING)
    post = post.filter(rows["kind"] == POSTING)
    if not hot.isEmpty():
        post = post.unionByName(hot.distinct())
    post = held(post.join(sets, ["key", "n"])
                 .select("token", "n", "pos", "bits", F.struct("key", "doc_id", "line_no").alias("at"), F.struct("doc_id", "line_no").alias("place"),
                         F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3))).cast("int").alias("band")))
    size = post.count()
    left, settled = post, None
    waiting = _open_pairs(post, post)
    for seed in range(STAR_ROUNDS):
        if waiting <= OPEN * size:  # little left
            break
        new = _verified(_passing(_star(post, left, seed)), docs)
        settled = new if settled is None else settled.unionByName(new)
        left = held(_unsettled(left, new))
        before, waiting = waiting, _open_pairs(post, left)
        if seed and 2 * waiting > before:  # nothing that pivots settle
            break
    others = post.select("token", F.col("n").alias("ny"), F.col("pos").alias("py"), F.col("bits").alias("by"), F.col("at").alias("y"), F.col("place").alias("y_place"))
    pairs = (left.join(others, "token").filter(F.col("y_place") < F.col("place"))
             .select(F.col("at").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"), F.col("bits").alias("bx"), "y", "ny", "py", "by")
             .filter(may_match(*map(F.col, ("nx", "ny", "px", "py"))) & bits_agree(*map(F.col, ("bx", "by", "nx", "ny")))))
    new = _verified(_passing(pairs), docs)
    settled = new if settled is None else settled.unionByName(new)
    return sets.select("doc_id", "line_no"), gone.unionByName(settled.select("doc_id", "line_no"))


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, removed) of every line that is not blank."""
    sets, gone = _found(docs)
    gone = gone.distinct().withColumn("removed", F.lit(True))
    return sets.join(gone, ["doc_id", "line_no"], "full").select("doc_id", "line_no", F.coalesce("removed", F.lit(False)).alias("removed"))


def _unsettled(post: DataFrame, settled: DataFrame) -> DataFrame:
    return post.withColumn("key", F.col("at.key")).join(settled.select("key"), "key", "left_anti").drop("key")


def _star(post: DataFrame, left: DataFrame, seed: int) -> DataFrame:
    """Unsettled lines against one earlier line per (token, band): the first one, later a pseudo-random one."""
    entry = F.struct(F.col("place"), F.col("at").alias("y"), F.col("n").alias("ny"), F.col("pos").alias("py"), F.col("bits").alias("by"))
    pick = F.min(entry) if seed == 0 else F.min_by(entry, F.xxhash64("token", "at.key", F.lit(seed)))
    pivots = (post.groupBy("token", "band").agg(pick.alias("p"))
              .select("token", F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1)).alias("band"), "p"))
    return (left.join(pivots, ["token", "band"])
            .filter((F.col("p.place") < F.col("place")) & may_match(F.col("n"), F.col("p.ny"), F.col("pos"), F.col("p.py"))
                    & bits_agree(F.col("bits"), F.col("p.by"), F.col("n"), F.col("p.ny")))
            .select(F.col("at").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"), "p.y", "p.ny", "p.py"))


def _open_pairs(post: DataFrame, left: DataFrame) -> int:
    """At most so many pairs of postings would be enumerated."""
    lists = post.groupBy("token").agg(F.count("*").alias("m"))
    waiting = lists.withColumn("w", F.col("m")) if left is post else left.groupBy("token").agg(F.count("*").alias("w")).join(lists, "token")
    return int(waiting.agg(F.sum(F.col("w") * F.col("m") - F.col("w") * (F.col("w") + 1) / 2)).first()[0] or 0)


@row_keyed("doc_id")
def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the later matches taken out of ``text``, and n_lines, n_removed (in place of columns of that name)."""
    gone = _found(docs)[1].groupBy("doc_id").agg(F.array_distinct(F.collect_list(F.col("line_no").cast("int"))).alias("__gone"))
    gone = held(gone)
    if (gone.agg(F.sum(F.size("__gone") + 1)).first()[0] or 0) <= FEW:
        gone = F.broadcast(gone)  # some 30 MB at most; beyond that both sides are shuffled, the texts too

    own = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    joined = (docs.withColumn("__text", F.coalesce("text", F.lit("")).cast("binary")).join(gone, "doc_id", "left")
              .select(*(F.col(f"`{c}`") for c in own), "__text", "__gone"))
    schema = T.StructType([*(docs.schema[c] for c in own), T.StructField("text", T.StringType()),
                           T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])

    def cut(batches):
        for batch in batches:
            for at in range(0, len(batch), 128):  # few texts are held twice
                part = batch.slice(at, 128)
                texts, counts, removed = [], [], []
                for data, drop in zip(part.column(len(own)), part.column(len(own) + 1).to_pylist(), strict=True):
                    data = data.as_py()
                    counts.append(data.count(b"\n") + 1)
                    removed.append(len(drop or ()))
                    if drop:
                        drop = set(drop)
                        data = b"\n".join(x for i, x in enumerate(data.split(b"\n")) if i not in drop)
                    texts.append(data)
                yield pa.RecordBatch.from_arrays([part.column(j) for j in range(len(own))] + [
                    pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], [*own, "text", "n_lines", "n_removed"])

    return joined.mapInArrow(cut, schema)
