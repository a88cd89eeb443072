"""Continuation-token store (O1, O2).

The store is an append-only table ``(survey_id, continuation_token,
created_at)``. The latest token is looked up for all surveys at once with
one grouped ``max_by`` (partial aggregation before the shuffle, so a survey
holding a third of all rows costs one row per map task), instead of one
``ORDER BY ... LIMIT 1`` query per survey.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN_SCHEMA = "survey_id string, continuation_token string, created_at timestamp"


def latest_tokens(tokens: DataFrame, surveys: DataFrame | None = None) -> DataFrame:
    """Latest token per survey; ``''`` for a listed survey without one.

    Ties on ``created_at`` (arbitrary in a LIMIT 1 query) are broken by the
    larger token so the answer is deterministic.
    """
    latest = tokens.groupBy("survey_id").agg(
        F.max_by("continuation_token", F.struct("created_at", "continuation_token")).alias("continuation_token")
    )
    if surveys is None:
        return latest
    return (surveys.select("survey_id").join(latest, "survey_id", "left")
            .select("survey_id", F.coalesce("continuation_token", F.lit("")).alias("continuation_token")))


def append_tokens(new_tokens: DataFrame, store_path: str) -> None:
    """Append ``(survey_id, continuation_token)`` rows stamped with the current time."""
    (new_tokens.select("survey_id", "continuation_token")
     .withColumn("created_at", F.current_timestamp())
     .write.mode("append").parquet(store_path))


def read_tokens(spark, store_path: str) -> DataFrame:
    return spark.read.schema(TOKEN_SCHEMA).parquet(store_path)
