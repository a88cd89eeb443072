"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm import divergence, imatch, merkle, token_store
from varloom.llm.ann import nearest
from varloom.llm.common import documents
from varloom.llm.imatch import fingerprints
from varloom.llm.line_dedup import dedup_lines
from varloom.llm.ngram_join import ngram_components
from varloom.llm.packing import pack
from varloom.llm.piece_sampling import sample_pieces
from varloom.llm.pii import personal_data
from varloom.llm.quality import classify
from varloom.llm.suffix_dedup import dedup_substrings
from varloom.llm.token_counts import token_counts
from varloom.session import work_dir


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(documents(spark, sf_dir)).drop("kept")


def op6_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_pieces(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), 0.7)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_removed", "text", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))


def op11_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = documents(spark, sf_dir), work_dir(spark, "token-store")
    token_store.store(docs, tokenizer("word_bpe_49k.json"), folder)
    found = token_store.fetch(spark, folder, token_store.keys_of(docs))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"), "copy")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"), merkle.lower_some())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_ngram_join": op2_ngram_join,
    "op3_packing": op3_packing,
    "op4_nearest": op4_nearest,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_piece_sampling": op6_piece_sampling,
    "op7_quality": op7_quality,
    "op8_line_dedup": op8_line_dedup,
    "op9_fingerprints": op9_fingerprints,
    "op10_pii": op10_pii,
    "op11_token_store": op11_token_store,
    "op12_divergence": op12_divergence,
    "op13_merkle": op13_merkle,
}

ORACLES: dict[str, str] = {"op9_fingerprints": imatch.ORACLE, "op12_divergence": divergence.ORACLE, "op13_merkle": merkle.oracle()}
