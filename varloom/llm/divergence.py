"""Source divergence audit: how far each source's vocabulary is from every other source's, by three-dimensional cube partitioning.

Terms are runs of letters (A-Z lower-cased; any character beyond ASCII counts as a letter). A language keeps the terms that ``MIN_DOCS`` of its
documents hold. A (lang, source) group gives every kept term the probability p = 1 + floor(10^9 (count + 1) / (N + V)), in billionths, and
f(p, q) = floor((p - q)^2 / q) is a term's share of the chi-square divergence of p from q. All arithmetic is in whole numbers.

Counting is one pass over the texts: a task sums its terms in a bounded table per group, Spark sums the rest. The
pairs of groups are then a product of three axes: blocks of ``GROUPS`` groups, blocks of as many others, blocks of about ``TERMS`` terms.
A slice (groups, terms) holds the probabilities of the terms that occur there; it is sent to every cell (groups, groups, terms) that needs it;
the cell's task computes the divergences of its pairs over its terms; sums along the term axis finish them. A cell
holds at most two slices of GROUPS x TERMS numbers, whatever the size of a source, language or
vocabulary. Terms that a group lacks have one probability per group and fill the slices as such.

Edge cases: null text, lang or source count as the empty text; a group without terms or a language without kept terms has
its pairs all the same (value 0 where no term is kept); rows repeated are documents of their own; texts of any length are counted in parts;
an empty table gives an empty result; a source alone in its language has no pairs; further columns are
ignored. Counts may be as large as 10^18 / 2.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import ship, stage

MIN_DOCS, SCALE, TOP = 3, 10**9, 200
GROUPS, TERMS = 32, 4096
HELD = 300_000   # terms that a task sums before it passes them on
PART = 1 << 20   # bytes of a text counted at once

# every byte but letters and bytes beyond ASCII becomes a space; A-Z become a-z
_FOLD = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in parts."""
    at, n = 0, len(text)
    while at < n:
        end = at + PART
        part = text[at:end].translate(_FOLD)
        if end < n and not part.endswith(b" "):  # back to the last separator, or on to the next
            cut = part.rfind(b" ")
            while cut < 0 and end < n:
                part += text[end:end + PART].translate(_FOLD)
                cut = part.rfind(b" ", end - at)
                end += PART
            if cut >= 0:
                part, end = part[:cut], at + cut + 1
        yield part.split()
        at = end


def _count(batches) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, df) of the texts of a task; a row without term for every group."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, df) in counts.items():
            terms = list(n)
            for at in range(0, max(len(terms), 1), 1 << 16):
                part = terms[at:at + (1 << 16)]
                size = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (size + 1), pa.string()), pa.array([source] * (size + 1), pa.string()), pa.array([*part, None], pa.binary()),
                     pa.array([*(n[t] for t in part), 0], pa.int64()), pa.array([*(df[t] for t in part), 0], pa.int64())],
                    ["lang", "source", "term", "n", "df"])

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, (lang, source) in enumerate(zip(langs, sources, strict=True)):
            n, df = counts.setdefault((lang, source), (Counter(), Counter()))
            text = Counter()
            for words in _words(batch.column(2)[i].as_py()):
                text.update(words)
            held -= len(n)
            n.update(text)
            df.update(text.keys())
            held += len(n)
            if held + len(counts) > HELD:
                yield from flush()
                counts, held = {}, 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents of every term of every group; a null term stands for the group itself."""
    parts = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
                        F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return (parts.mapInArrow(_count, "lang string, source string, term binary, n long, df long")
            .groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("df").alias("df")))


def probability(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE (count + 1) / (total + kept)), exact for counts of up to 28 digits."""
    return F.lit(1) + F.call_function("div", (count + 1).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)"), (total + kept).cast("decimal(38,0)"))


def share(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q): at most SCALE^2, so within a long."""
    return F.call_function("div", (p - q) * (p - q), q)


class Vocabulary:
    """Staged counts of the kept terms of every group and language."""

    def __init__(self, docs: DataFrame):
        counts = stage(term_counts(docs), "divergence-counts")
        kept = (counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("df").alias("df"))
                .filter(F.col("df") >= MIN_DOCS).drop("df"))
        kept = stage(kept, "divergence-kept")
        langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_total"))
        langs = counts.select("lang").distinct().join(langs, "lang", "left").fillna(0)
        langs = langs.withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("kept") / TERMS)).cast("int"))
        self.langs = stage(langs, "divergence-langs")
        # a term's place: the block that its hash names, its number there
        place = Window.partitionBy("lang", "block").orderBy("term")
        kept = kept.join(self.langs.select("lang", "n_blocks"), "lang").withColumn("block", F.pmod(F.xxhash64("term"), "n_blocks").cast("int"))
        self.terms = stage(kept.select("lang", "term", "total", "block", (F.row_number().over(place) - 1).alias("at")), "divergence-terms")
        self.own = stage(counts.filter("term is not null").select("lang", "source", "term", "n").join(self.terms, ["lang", "term"]), "divergence-own")
        totals = self.own.groupBy("lang", "source").agg(F.sum("n").alias("n"))
        number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        groups = (counts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").fillna(0, ["n"]).join(self.langs, "lang")
                  .withColumn("number", number)
                  .select("lang", "source", F.col("n").alias("group_total"), "kept", "lang_total", "n_blocks",
                          F.floor(F.col("number") / GROUPS).cast("int").alias("gblock"), (F.col("number") % GROUPS).cast("int").alias("g")))
        self.groups = stage(groups, "divergence-groups")


def top_terms(v: Vocabulary) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a group has more of than its language, the farthest first."""
    rows = v.own.join(v.groups.select("lang", "source", "group_total", "kept", "lang_total"), ["lang", "source"])
    rows = rows.select("lang", "source", F.col("term").alias("item"), probability(F.col("n"), F.col("group_total"), F.col("kept")).alias("p"),
                       probability(F.col("total"), F.col("lang_total"), F.col("kept")).alias("q")).filter("p > q")
    rows = rows.select("lang", "source", "item", share(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)


def slices(v: Vocabulary) -> DataFrame:
    """(lang, gblock, block, n_terms, base, entries): the probabilities of one block of groups for one block of terms.

    ``base``: each group's probability of a term that it lacks; ``entries``: structs (g, at, p) of those that it has.
    """
    p = probability(F.col("n"), F.col("group_total"), F.col("kept"))
    entries = (v.own.join(v.groups.select("lang", "source", "group_total", "kept", "gblock", "g"), ["lang", "source"])
               .groupBy("lang", "gblock", "block").agg(F.collect_list(F.struct("g", "at", p.alias("p"))).alias("entries")))
    lacking = F.when(F.col("kept") > 0, probability(F.lit(0), F.col("group_total"), F.col("kept"))).otherwise(F.lit(1).cast("long"))
    grid = (v.groups.groupBy("lang", "gblock", "n_blocks").agg(F.sort_array(F.collect_list(F.struct("g", lacking.alias("p"), "source"))).alias("base"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))))
    sizes = v.terms.groupBy("lang", "block").agg(F.count("*").alias("n_terms"))
    return (grid.join(sizes, ["lang", "block"], "left").join(entries, ["lang", "gblock", "block"], "left")
            .select("lang", "gblock", "block", F.coalesce("n_terms", F.lit(0)).cast("int").alias("n_terms"),
                    F.expr("transform(base, x -> x.p)").alias("base"), F.expr("transform(base, x -> x.source)").alias("sources"), "entries"))


def _dense(base: pa.Scalar, entries: pa.Scalar, n_terms: int) -> np.ndarray:
    out = np.repeat(np.array(base.as_py(), np.int64)[:, None], n_terms, axis=1)
    if entries.is_valid and len(entries.values):
        g, at, p = (entries.values.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        out[g, at] = p
    return out


def _cells(batches) -> Iterator[pa.RecordBatch]:
    """(lang, source, item, value) of the pairs of a cell, over the cell's terms."""
    for batch in batches:
        for i in range(batch.num_rows):
            lang, n_terms, base, sources, entries, other_base, items, other_entries = (c[i] for c in batch.columns)
            p, q = _dense(base, entries, n_terms.as_py()), _dense(other_base, other_entries, n_terms.as_py())
            sources, items = sources.as_py(), items.as_py()
            for source, row in zip(sources, p, strict=True):
                gap = row[None, :] - q
                value = (gap * gap // q).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()] * len(items), pa.string()), pa.array([source] * len(items), pa.string()),
                                                  pa.array(items, pa.string()), pa.array(value, pa.int64())], ["lang", "source", "item", "value"])


def pair_divergences(v: Vocabulary) -> DataFrame:
    """(lang, source, item, value): the divergence of every group from every other group of its language."""
    cut = stage(slices(v), "divergence-slices")
    across = v.groups.groupBy("lang").agg((F.max("gblock") + 1).alias("n_gblocks"))
    sent = cut.join(across, "lang").withColumn("to", F.explode(F.sequence(F.lit(0), F.col("n_gblocks") - 1)))
    left = sent.select("lang", F.col("gblock").alias("i"), F.col("to").alias("j"), "block", "n_terms", "base", "sources", "entries")
    right = sent.select("lang", F.col("to").alias("i"), F.col("gblock").alias("j"), "block", F.col("base").alias("other_base"),
                        F.col("sources").alias("other_sources"), F.col("entries").alias("other_entries"))
    cells = left.join(right, ["lang", "i", "j", "block"]).select(
        "lang", "n_terms", "base", "sources", "entries", "other_base", "other_sources", "other_entries")
    partial = cells.mapInArrow(_cells, "lang string, source string, item string, value long").filter("source <> item")
    return partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    ship(docs.sparkSession)
    v = Vocabulary(docs)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_divergences(v).withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("part", F.lit("pair")).select(columns)
            .unionByName(top_terms(v).withColumn("part", F.lit("term")).select(columns)))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
kept AS (SELECT lang, term, count(*) AS total FROM d GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
own AS (SELECT d.lang, d.source, d.term, count(*) AS n FROM d JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM grp LEFT JOIN own USING (lang, source) GROUP BY ALL),
p AS (SELECT t.lang, t.source, k.term, o.n AS count,
             1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 1)) // (t.n + l.v)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (k.total + 1)) // (l.n + l.v)::HUGEINT AS q
      FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN own o USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item,
                 coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // y.p) FROM p x JOIN p y USING (lang, term)
                           WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE count > 0 AND p > q),
ranked AS (SELECT 'pair' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
           UNION ALL SELECT 'term', *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
