"""Document fingerprints: I-Match over randomised lexicon subsets (DataFrame functions only).

The lexicon holds the terms whose inverse document frequency lies in a band:
``min_df <= df <= n_docs / COMMON``. ``min_df`` is the largest of 2,
``n_docs / RARE`` and (all distinct terms of all documents) / LEXICON, so the lexicon
never has more than LEXICON terms and may be broadcast. A document keeps its
distinct lexicon terms, sorts them, and for every randomised subset of the
lexicon hashes the sorted terms that fall into it. Subsets have different
rates, so a short and a long document both have some of one or two terms,
which survive edits elsewhere. The likeness of two fingerprints is the share
of equal hashes among the subsets that either document has terms in.

A document without any lexicon term is fingerprinted by its whole text.

Edge cases: a null text counts as empty; the empty text is its own edited
text; a single document is its own next one; repeated rows with the same doc_id and
text are one document and one row, the same doc_id with different texts are several, in the
order of their texts' hashes; a null doc_id is an id like any other and comes first; texts are taken whole, whatever their length; an empty table gives an empty result; further
columns are ignored. Document order is found with a range partitioning, so no
task sees all ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.llm.common import id_text, row_keyed, stage

COMMON, RARE, LEXICON = 10, 1000, 1 << 18
#: Randomised subsets: (number, hexadecimal bound on the digest of "subset:term"); rates 1/16, 1/64, 1/256, 1/1024.
SUBSETS = [(8, "1"), (10, "04"), (12, "01"), (10, "004")]
SLOTS = [bound for n, bound in SUBSETS for _ in range(n)]
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
SIDE = len(SLOTS) + 1  # the edited text's slots are numbered from here on; each side ends with the blank term's slot
KEY = ["doc_id", "h"]


def terms(text: Column) -> Column:
    """Distinct lower-case terms: runs of letters and digits (any character beyond ASCII included)."""
    return F.array_distinct(F.split(F.lower(text), SEPARATORS))


def lexicon(docs: DataFrame) -> DataFrame:
    """(term, subsets) of the band; subsets: the numbers of the randomised subsets that hold the term."""
    n_docs = docs.count()
    df = stage(docs.select(F.explode(terms(F.col("text"))).alias("term")).filter("term <> ''")
               .groupBy("term").agg(F.count("*").alias("df")).filter("df > 1"), "imatch-df")
    total = df.agg(F.sum("df")).first()[0] or 0
    min_df = max(2, -(-n_docs // RARE), -(-total // LEXICON))
    within = [F.when(F.substring(F.md5(F.concat(F.lit(f"{r}:"), "term").cast("binary")), 1, len(bound)) < bound, F.lit(r))
              for r, bound in enumerate(SLOTS)]
    band = stage(df.filter((F.col("df") >= min_df) & (F.col("df") * COMMON <= n_docs))
                 .select("term", F.array_compact(F.array(*within)).alias("subsets")), "imatch-lexicon")
    return band.filter(F.size("subsets") > 0)  # on the stored column: the optimizer would unfold the expression


def in_document_order(docs: DataFrame) -> DataFrame:
    """(doc_id, h, n_chars, at): the position of every distinct document in ascending order."""
    ids = docs.select("doc_id", F.xxhash64("text").alias("h"), F.length("text").cast("long").alias("n_chars")).distinct()
    dealt = stage(ids.repartitionByRange(*KEY).sortWithinPartitions(*KEY)
                  .withColumn("part", F.spark_partition_id()).withColumn("m", F.monotonically_increasing_id()), "imatch-order")
    # one row per partition
    base = dealt.groupBy("part").agg(F.count("*").alias("n"), F.min("m").alias("first"))
    base = base.withColumn("base", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    return dealt.join(F.broadcast(base), "part").select(
        *KEY, "n_chars", (F.coalesce("base", F.lit(0)) + F.col("m") - F.col("first")).alias("at"))


def slot_hashes(hits: Column) -> Column:
    """Per slot the hash of its terms, or nothing, joined by "-". ``hits``: sorted structs (slot, term).

    One pass: a new slot closes the one before it and adds the dashes up to itself. The blank term closes each side.
    """
    zero = F.struct(F.lit(0).alias("slot"), F.lit("").alias("text"), F.lit("").alias("out"))
    digest = lambda acc: F.when(acc["text"] == "", F.lit("")).otherwise(F.substring(F.md5(acc["text"].cast("binary")), 1, 8))

    def step(acc, x):
        same = acc["slot"] == x["slot"]
        return F.struct(x["slot"].alias("slot"),
                        F.when(same & (acc["text"] != ""), F.concat(acc["text"], F.lit(" "), x["term"])).otherwise(x["term"]).alias("text"),
                        F.when(same, acc["out"]).otherwise(F.concat(acc["out"], digest(acc), F.repeat(F.lit("-"), x["slot"] - acc["slot"]))).alias("out"))

    return F.aggregate(hits, zero, step, lambda acc: acc["out"])


def _print(slots: Column, side: int, text_sha: Column) -> Column:
    text = F.array_join(F.slice(F.split(slots, "-"), side * SIDE + 1, len(SLOTS)), "-")
    return F.when(F.length(text) >= len(SLOTS), text).otherwise(F.concat(F.lit("w"), F.substring(text_sha, 1, 16)))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1, of two fingerprints as strings."""
    x, y = F.split(a, "-"), F.split(b, "-")
    pairs = F.arrays_zip(x.alias("x"), y.alias("y"))
    used = F.size(F.filter(pairs, lambda p: (F.coalesce(p["x"], F.lit("")) != "") | (F.coalesce(p["y"], F.lit("")) != "")))
    same = F.size(F.filter(pairs, lambda p: (p["x"] == p["y"]) & (p["x"] != "")))
    return F.when(a == b, 1.0).otherwise(F.coalesce(same / F.nullif(used, F.lit(0)), F.lit(0.0)))


@row_keyed("doc_id")
def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    docs = id_text(docs)
    lex = lexicon(docs).unionByName(docs.sparkSession.sql("SELECT '' AS term, array(-1) AS subsets")
                                    .withColumn("subsets", F.array(F.lit(len(SLOTS)))))

    order = in_document_order(docs)
    n = order.count()
    nxt = order.select(F.pmod(F.col("at") - 1, F.lit(max(n, 1))).alias("at"), *(F.col(c).alias(f"next_{c}") for c in KEY))
    chain = stage(order.join(nxt, "at"), "imatch-chain")

    named = docs.withColumn("h", F.xxhash64("text")).dropDuplicates(KEY)
    wanted = chain.select(F.col("next_doc_id").alias("doc_id"), F.col("next_h").alias("h"),
                          F.col("doc_id").alias("to_doc_id"), F.col("h").alias("to_h"), F.floor(F.col("n_chars") / 2).cast("int").alias("half"))
    # the part of a document that its predecessor takes
    taken = (named.join(wanted, KEY)
             .select(F.col("to_doc_id").alias("doc_id"), F.col("to_h").alias("h"), F.left("text", "half").alias("tail")))
    both = (named.join(taken, KEY)
            .withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("edited", F.concat(F.left("text", (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int")), "tail"))
            .withColumn("sha", F.sha2("text", 256)).withColumn("edited_sha256", F.sha2("edited", 256)))

    blank = F.array(F.lit(""))  # a term that every document has, so that none is lost; its row carries the other columns
    sided = both.select(*KEY, "n_chars", "sha", "edited_sha256", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.array_union(blank, terms(F.col("text"))).alias("terms")),
        F.struct(F.lit(SIDE).alias("side"), F.array_union(blank, terms(F.col("edited"))).alias("terms")))).alias("s"))
    hits = (sided.select(*KEY, "n_chars", "sha", "edited_sha256", "s.side", F.explode("s.terms").alias("term"))
            .join(F.broadcast(lex), "term")
            .select(*KEY, *(F.when(F.col("term") == "", F.col(c)).alias(c) for c in ("n_chars", "sha", "edited_sha256")),
                    "side", "term", F.explode("subsets").alias("slot")))
    prints = (hits.groupBy(*KEY)
              .agg(F.max("n_chars").alias("n_chars"), F.max("sha").alias("sha"), F.max("edited_sha256").alias("edited_sha256"),
                   F.sort_array(F.collect_list(F.struct((F.col("side") + F.col("slot")).alias("slot"), "term"))).alias("hits"))
              .select(*KEY, "n_chars", "sha", "edited_sha256", slot_hashes(F.col("hits")).alias("slots")))
    prints = stage(prints, "imatch-prints").select(
        *KEY, "n_chars", "edited_sha256", _print(F.col("slots"), 0, F.col("sha")).alias("fingerprint"),
        _print(F.col("slots"), 1, F.col("edited_sha256")).alias("edited_fingerprint"))
    following = prints.select(F.col("doc_id").alias("next_doc_id"), F.col("h").alias("next_h"), F.col("fingerprint").alias("next_print"))
    return (prints.join(chain.select(*KEY, "next_doc_id", "next_h"), KEY).join(following, ["next_doc_id", "next_h"])
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).cast("double").alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_print")).cast("double").alias("near_next")))


#: The same fingerprints by DuckDB (unique doc_ids, as in the given tables).
ORACLE = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM documents),
chain AS (SELECT *, coalesce(lead(doc_id) OVER (ORDER BY doc_id), min(doc_id) OVER ()) AS next_id FROM docs),
edits AS (SELECT c.doc_id, c.n_chars, c.next_id, c.text, left(c.text, c.n_chars - c.n_chars // 2) || left(n.text, c.n_chars // 2) AS edited
         FROM chain c JOIN docs n ON n.doc_id = c.next_id),
sided AS (SELECT doc_id, 0 AS side, text FROM edits UNION ALL SELECT doc_id, 1, edited FROM edits),
words AS (SELECT DISTINCT doc_id, side, term FROM (
            SELECT doc_id, side, unnest(string_split_regex(lower(text), '{SEPARATORS}')) AS term FROM sided) WHERE term <> ''),
freq AS (SELECT term, count(*) AS df FROM words WHERE side = 0 GROUP BY term HAVING count(*) > 1),
band AS (SELECT term FROM freq WHERE df * {COMMON} <= (SELECT count(*) FROM docs)
         AND df >= greatest(2, ceil((SELECT count(*) FROM docs) / {RARE}.0), ceil((SELECT sum(df) FROM freq) / {LEXICON}.0))),
hit AS (SELECT w.* FROM words w SEMI JOIN band USING (term)),
slots AS (SELECT h.doc_id, h.side, {", ".join(
    f"substr(md5(string_agg(term, ' ' ORDER BY term) FILTER (WHERE substr(md5('{r}:' || term), 1, {len(b)}) < '{b}')), 1, 8) AS s{r}"
    for r, b in enumerate(SLOTS))} FROM hit h GROUP BY ALL),
prints AS (SELECT d.doc_id, d.side,
    CASE WHEN coalesce({", ".join(f"s{r}" for r in range(len(SLOTS)))}) IS NULL THEN 'w' || substr(sha256(d.text), 1, 16)
         ELSE concat_ws('-', {", ".join(f"coalesce(s{r}, '')" for r in range(len(SLOTS)))}) END AS p
    FROM sided d LEFT JOIN slots s ON s.doc_id = d.doc_id AND s.side = d.side),
wide AS (SELECT b.doc_id, b.n_chars, sha256(b.edited) AS edited_sha256, o.p AS fingerprint, e.p AS edited_fingerprint, n.p AS next_print
    FROM edits b JOIN prints o ON o.doc_id = b.doc_id AND o.side = 0 JOIN prints e ON e.doc_id = b.doc_id AND e.side = 1
    JOIN prints n ON n.doc_id = b.next_id AND n.side = 0),
z AS (SELECT *, string_split(fingerprint, '-') AS x, string_split(edited_fingerprint, '-') AS y, string_split(next_print, '-') AS v FROM wide)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  CASE WHEN fingerprint = edited_fingerprint THEN 1.0 ELSE
    coalesce(len(list_filter(list_zip(x, y), lambda p: p[1] = p[2] AND p[1] <> ''))::DOUBLE
      / nullif(len(list_filter(list_zip(x, y), lambda p: coalesce(p[1], '') <> '' OR coalesce(p[2], '') <> '')), 0), 0) END::DOUBLE AS near_edited,
  CASE WHEN fingerprint = next_print THEN 1.0 ELSE
    coalesce(len(list_filter(list_zip(x, v), lambda p: p[1] = p[2] AND p[1] <> ''))::DOUBLE
      / nullif(len(list_filter(list_zip(x, v), lambda p: coalesce(p[1], '') <> '' OR coalesce(p[2], '') <> '')), 0), 0) END::DOUBLE AS near_next
FROM z
"""
