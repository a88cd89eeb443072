"""A corpus from raw documents to packed sequences, by the operators of ``varloom.llm``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``documents``, with ``n_chars`` kept in step with
the text. ``run`` writes each stage's result to the shared folder and reads it back for the next one.

Edge cases hold as the operators state them; null texts come out empty, columns beyond those of ``documents`` are kept
whatever their names; rows without doc_id or that share one with another text are documents of their own, and of rows with one
doc_id and text one stays in the n-gram stage (any of them, where other columns differ).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm import line_dedup, ngram_join, packing, pii, quality
from varloom.llm.common import aside, row_keys, ship, stage
from varloom.llm.queries import tokenizer


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.7 or more)."""
    ship(spark)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    inner, back = aside(docs)
    return back(quality.scores(inner, model, inner.columns).filter("score >= 0.7"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later matches of lines go; a document of which not a word is left goes with them."""
    inner, back = aside(docs)
    out = line_dedup.dedup_lines(inner)
    return back(_counted(out.filter("n_removed = 0 or text rlike '[^\\\\x20\\\\x09-\\\\x0D]'"), docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by n-gram similarity the one with the smallest doc_id stays."""
    inner, back = aside(docs)
    ship(spark)
    keyed, names = row_keys(inner)
    found = ngram_join.ngram_components(keyed)
    kept = found.filter("doc_id = component_id").select("doc_id").distinct()
    out = keyed.join(kept, "doc_id", "left_semi")
    if names is not None:
        names = names.select(F.col("__key").alias("doc_id"), "__id")
        out = out.dropDuplicates(["doc_id"]).join(names, "doc_id").withColumn("doc_id", F.col("__id")).drop("__id")
    return back(out)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets."""
    inner, back = aside(docs)
    return back(_counted(pii.mask(inner), docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: None: a trained classifier has no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def _counted(inner: DataFrame, docs: DataFrame) -> DataFrame:
    """n_chars (under the name that ``aside`` gave it) as the length of the text."""
    name = aside(docs, name_of="n_chars")
    return inner.withColumn(name, F.length("text").cast(docs.schema["n_chars"].dataType)) if name else inner


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
