r"""Personal data: bootstrapped contextual extraction (DataFrame functions only).

Base spans come from four patterns (fixed below). They are the seeds: the
words to the left and right of a seed are contexts; a context is scored by
how many of the distinct identifier-like strings seen in it are known for
its kind, trusted contexts vouch for the strings they surround, and strings
vouched for by enough contexts become known in turn. When a round finds
nothing new, every occurrence of a string found this way is a span of its kind, beside
the base spans. Candidate strings are single words that hold a digit, so the
graph of contexts and strings is small beside the corpus and every round is
two partial aggregates and two joins.

The patterns are the contract's with possessive repetition and a start
condition, which finds the same matches without backtracking: a run of
characters that failed once is not tried again from its middle, and long
digit or letter runs need neither quadratic time nor deep recursion.

Edge cases: a null text counts as empty; repeated rows give a row each; rows that share a doc_id but not
their text are documents of their own, a null doc_id is an id like any other; texts are taken whole, whatever their length; without
any seed nothing is learned; an empty table gives an empty result; further
columns are ignored (``mask`` keeps them). Positions are code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import held, id_text, row_keyed

#: kind -> pattern, in the order of the output (Java syntax).
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CANDIDATE = r"(?:\G|(?<![A-Za-z0-9._@-]))(?=[A-Za-z._@-]*+[0-9])[A-Za-z0-9][A-Za-z0-9._@-]{4,62}[A-Za-z0-9](?![A-Za-z0-9._@-])"
SUPPORT = 3        # distinct known strings a trusted context has at least
PRECISION = 0.8    # share of known strings among those seen in a trusted context
VOUCHERS = 2       # trusted contexts that a new string needs


def _digits(x: Column) -> Column:
    return F.translate(x, " -+().", "")


def _valid(kind: str, found: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3)
                        & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    d = _digits(found)
    n = F.length(d)
    if kind == "phone":
        return n.between(9, 15)
    # Luhn: from the right, every second digit doubled, digits of the products added up
    digit = lambda i: F.substring(d, (n - i).cast("int"), F.lit(1)).cast("int")
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + F.when(i % 2 == 0, digit(i)).otherwise(
        F.when(digit(i) * 2 > 9, digit(i) * 2 - 9).otherwise(digit(i) * 2)))
    return F.when(n.between(13, 19), total % 10 == 0).otherwise(F.lit(False))


def located(text: Column, pattern: str) -> Column:
    """array<struct<s, e, v>> of all leftmost, non-overlapping matches.

    The match lengths and the lengths of the pieces between them add up to the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,v:string>>").alias("out"))

    def step(acc, m):
        s = acc["at"] + F.length(m["g"])
        e = s + F.length(m["v"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), m["v"].alias("v")))).alias("out"))

    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("g"), found.alias("v"))
    return F.when(F.size(found) > 0, F.aggregate(pairs, zero, step)["out"])


def _spans(text: Column, kind: str) -> Column:
    """Valid spans of one kind, null where the text has none at all."""
    quick = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind, F.rlike(text, F.lit("[0-9]")))
    spans = F.filter(located(text, KINDS[kind]), lambda x: _valid(kind, x["v"]))
    return F.when(quick, spans)


def _text_of(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def base_spans(docs: DataFrame) -> DataFrame:
    """Input columns and one array column per kind."""
    return docs.select("*", *(F.coalesce(_spans(F.col("text"), k), F.array().cast("array<struct<s:int,e:int,v:string>>")).alias(f"b_{k}")
                              for k in KINDS))


def _of_kind(kind: str | None):
    """Puts the kind before a span's fields."""
    return lambda x: F.struct(F.lit(kind).cast("string").alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v"))


def _contexts(docs: DataFrame) -> DataFrame:
    """(kind or null, string, context) of seeds and candidate strings, a row for each place and context.

    A context is one or two lower-case words on one side; the side is part of it.
    """
    seeds = [F.transform(F.col(f"b_{k}"), _of_kind(k)) for k in KINDS]
    rough = F.when(F.rlike("text", F.lit("[0-9]")), located(F.col("text"), CANDIDATE))
    known = F.concat(*(F.col(f"b_{k}") for k in KINDS))
    fresh = F.transform(F.filter(F.coalesce(rough, F.array().cast("array<struct<s:int,e:int,v:string>>")),
                                 lambda c: ~F.exists(known, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"]))),
                        _of_kind(None))
    places = docs.select("doc_id", "text", F.explode(F.concat(*seeds, fresh)).alias("p"))
    around = places.select("doc_id", "p.kind", F.col("p.s").alias("s"), F.col("p.e").alias("e"), F.col("p.v").alias("v"),
                           F.lower(F.substring("text", F.greatest(F.col("p.s") - 39, F.lit(1)), F.least(F.col("p.s"), F.lit(40)))).alias("left"),
                           F.lower(F.substring("text", F.col("p.e") + 1, F.lit(40))).alias("right"))
    left = F.regexp_extract_all("left", F.lit(r"[^\s]+"), F.lit(0))
    right = F.regexp_extract_all("right", F.lit(r"[^\s]+"), F.lit(0))
    two = lambda w: F.array_join(w, " ")
    return around.withColumn("l", left).withColumn("r", right).select(
        "doc_id", "kind", "s", "e", "v",
        F.array_compact(F.array(
            F.when(F.size("l") >= 2, F.concat(F.lit("< "), two(F.slice("l", -2, 2)))),
            F.when(F.size("r") >= 2, F.concat(F.lit("> "), two(F.slice("r", 1, 2)))),
            F.when((F.size("l") >= 1) & (F.size("r") >= 1),
                   F.concat(F.lit("<> "), F.element_at("l", -1), F.lit(" "), F.try_element_at("r", F.lit(1)))))).alias("contexts"))


def learn(places: DataFrame) -> DataFrame:
    """(v, kind) of new strings. ``places``: kind, v, contexts; rows without a kind are candidates."""
    edges = held(places.select("kind", "v", F.explode("contexts").alias("context"))
                  .groupBy("context", "v").agg(F.max("kind").alias("kind")))
    known = edges.filter("kind is not null").groupBy("v").agg(F.min("kind").alias("known"))
    found = None
    while True:  # every round but the last one makes at least one more string known
        marked = edges.select("context", "v").join(known, "v", "left")
        seen = marked.groupBy("context").agg(F.count("*").alias("n"))
        trusted = (marked.filter("known is not null").groupBy("context", "known").agg(F.count("*").alias("hits"))
                   .filter(F.col("hits") >= SUPPORT).join(seen, "context")
                   .withColumn("score", F.col("hits") / F.col("n")).filter(F.col("score") >= PRECISION))
        new = (marked.filter("known is null").select("context", "v").join(trusted, "context")
               .groupBy("v", "known").agg(F.count("*").alias("vouchers"), F.max("score").alias("score"))
               .filter(F.col("vouchers") >= VOUCHERS)
               .groupBy("v").agg(F.max_by("known", F.struct("vouchers", "score", "known")).alias("known")))
        new = held(new)
        if new.isEmpty():
            return found
        found = new if found is None else found.unionByName(new)
        known = known.unionByName(new)


def find(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) and the arrays ``base`` and ``spans`` of structs (kind, s, e)."""
    full = base_spans(docs)
    places = held(_contexts(full.select("doc_id", "text", *(f"b_{k}" for k in KINDS))))
    found = learn(places)
    rank = F.create_map(*(F.lit(x) for pair in zip(KINDS, range(len(KINDS)), strict=True) for x in pair))
    order = lambda arr: F.transform(F.array_sort(F.transform(arr, lambda x: F.struct(
        rank[x["kind"]].alias("o"), x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")))),
        lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    base = F.concat(*(F.transform(F.col(f"b_{k}"), _of_kind(k)) for k in KINDS))
    full = full.withColumn("base", order(base))
    if found is None:
        return full.withColumn("spans", F.col("base"))
    extra = (places.filter("kind is null").join(found, "v")
             .select("doc_id", F.struct(F.col("known").alias("kind"), "s", "e").alias("x"))
             .groupBy("doc_id").agg(F.collect_set("x").alias("extra")))
    return (full.join(extra, "doc_id", "left")
            .withColumn("spans", F.when(F.col("extra").isNull(), F.col("base")).otherwise(order(F.concat("base", "extra"))))
            .drop("extra"))


@row_keyed("doc_id")
def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document."""
    out = find(id_text(docs))
    return out.select("doc_id", *(F.size(f"b_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
                      F.sha2(_text_of(F.col("base")).cast("binary"), 256).alias("base_sha256"), _text_of(F.col("spans")).alias("spans"))


@row_keyed("doc_id")
def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by ``[KIND]``; overlapping spans become one. All columns are kept."""
    columns = docs.columns
    out = find(docs.withColumn("text", F.coalesce("text", F.lit(""))))
    by_place = F.array_sort(F.transform(F.col("spans"), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(acc, x):
        cut = F.concat(acc["done"], F.substring("text", acc["at"] + 1, x["s"] - acc["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.when(x["s"] >= acc["at"], cut).otherwise(acc["done"]).alias("done"))

    folded = F.aggregate(by_place, zero, step)
    text = F.when(F.size("spans") == 0, F.col("text")).otherwise(
        F.concat(folded["done"], F.substring(F.col("text"), folded["at"] + 1, F.length("text"))))
    return out.withColumn("text", text).select(*columns)
