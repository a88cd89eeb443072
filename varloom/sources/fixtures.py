"""Response tables built from the supplied parquet tables (FIXTURES R1-R5).

Each fixture is a plain Spark job over the given tables, so its work grows
with them: projections push down to the parquet scan, aggregations are
partial (map-side) before their shuffle, and no group is ever collected
beyond a bounded domain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Read only ``cols`` of a table."""
    return table(spark, sf_dir, name).select(*cols)


def _num_text(c):
    return F.col(c).cast("string")


def lineitem_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1: one response per ``lineitem`` row; answers are the row's fields as text."""
    li = scan(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
              "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    rid = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    values = F.create_map(
        F.lit("qty"), F.col("l_quantity").cast("bigint").cast("string"),
        F.lit("disc"), _num_text("l_discount"),
        F.lit("tax"), _num_text("l_tax"),
        F.lit("line"), _num_text("l_linenumber"),
        F.lit("flag"), F.col("l_returnflag"),
        F.lit("status"), F.col("l_linestatus"),
    )
    return li.select(rid.alias("response_id"), values.alias("values"))


LINES = range(1, 8)


def order_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: one response per order; ``qty_<line>`` is absent when the line is missing.

    ``lineitem`` is pivoted on the fixed line-number domain with one partial
    aggregation keyed by order (no per-order list is collected); the result
    is hash-partitioned by order key, which the left join to ``orders``
    reuses, so ``lineitem`` is shuffled once.
    """
    li = table(spark, sf_dir, "lineitem")
    pivot = li.groupBy("l_orderkey").agg(
        *[F.max(F.when(F.col("l_linenumber") == i, F.col("l_quantity"))).alias(f"q{i}") for i in LINES]
    )
    orders = scan(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    joined = orders.join(pivot, orders.o_orderkey == pivot.l_orderkey, "left")
    prio = F.substring("o_orderpriority", 1, 1)
    kv = []
    for i in LINES:
        kv += [F.lit(f"qty_{i}"), F.col(f"q{i}").cast("bigint").cast("string")]
    kv += [F.lit("prio"), prio, F.lit("ostatus"), F.col("o_orderstatus")]
    values = F.map_filter(F.create_map(*kv), lambda k, v: v.isNotNull())
    return joined.select(
        F.col("o_orderkey").cast("string").alias("response_id"),
        F.concat(F.lit("SV_"), prio).alias("survey_id"),
        values.alias("values"),
    )


def document_responses(spark: SparkSession, sf_dir: str, variant: str = "A") -> DataFrame:
    """R3: ``documents`` with their ``labels``.

    Unlabelled documents have ``quality``/``toxic`` absent (A, D), null (B) or
    ``""`` (C); in D a labelled one with an even id has an empty ``toxic``. Only the needed columns are read (no document text).
    """
    docs = scan(spark, sf_dir, "documents", "doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = docs.join(labels, "doc_id", "left")
    labelled = F.col("quality").isNotNull()
    base = [F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"),
            F.lit("n_chars"), F.col("n_chars").cast("string")]
    lab = [F.lit("quality"), F.col("quality").cast("string"), F.lit("toxic"), F.col("toxic").cast("string")]
    if variant == "A":
        values = F.when(labelled, F.create_map(*base, *lab)).otherwise(F.create_map(*base))
    elif variant == "B":
        values = F.create_map(*base, *lab)
    elif variant == "C":
        empty = [F.lit("quality"), F.coalesce(F.col("quality").cast("string"), F.lit("")),
                 F.lit("toxic"), F.coalesce(F.col("toxic").cast("string"), F.lit(""))]
        values = F.create_map(*base, *empty)
    elif variant == "D":
        even = [F.lit("n_even"), F.when(F.col("n_chars") % 2 == 0, "1").otherwise("0")]
        half = [F.lit("quality"), F.col("quality").cast("string"),
                F.lit("toxic"), F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("toxic").cast("string"))]
        values = F.when(labelled, F.create_map(*base, *even, *half)).otherwise(F.create_map(*base, *even))
    else:
        raise ValueError("variant must be A, B, C or D")
    return j.select(F.col("doc_id").cast("string").alias("response_id"), values.alias("values"))


def event_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4: one response per user from ``events``.

    Keys: one per event type (its count), ``vals`` (the per-type counts as a
    list: JSON style for even users, comma text for odd ones) and ``k`` (max
    of ``props.k``). Events are first counted per (user, type) with a
    partial aggregation, so the per-user list is bounded by the event-type
    domain, never by the number of events of a hot user.
    """
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "props")
    per_type = ev.groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.max(F.get_json_object("props", "$.k").cast("bigint")).alias("k"),
    )
    per_user = per_type.groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.struct("event_type", "cnt"))).alias("types"),
        F.max("k").alias("k"),
    )
    counts = F.transform("types", lambda t: t["cnt"].cast("string"))
    vals = F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("["), F.array_join(counts, ", "), F.lit("]"))) \
        .otherwise(F.array_join(counts, ","))
    type_map = F.map_from_arrays(F.transform("types", lambda t: t["event_type"]), counts)
    values = F.map_concat(type_map, F.create_map(F.lit("vals"), vals, F.lit("k"), F.col("k").cast("string")))
    return per_user.select(F.col("user_id").cast("string").alias("response_id"), values.alias("values"))


def token_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 tokens: survey = user, token = event id, created_at = event time."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("survey_id"),
        F.col("event_id").cast("string").alias("continuation_token"),
        F.col("ts").alias("created_at"),
    )


def survey_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 surveys: distinct users, active when the user id is even."""
    ev = table(spark, sf_dir, "events").select("user_id").distinct()
    return ev.select(F.col("user_id").cast("string").alias("survey_id"),
                     (F.col("user_id") % 2 == 0).alias("is_active"))


def order_survey_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surveys of R2 (one per order-priority digit); digit 3 is inactive."""
    o = table(spark, sf_dir, "orders").select(F.substring("o_orderpriority", 1, 1).alias("d")).distinct()
    return o.select(F.concat(F.lit("SV_"), "d").alias("survey_id"), (F.col("d") != "3").alias("is_active"))
