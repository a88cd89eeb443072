"""Survey catalogue (O3, O4): list documents and the active filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIST_SCHEMA = "result struct<elements: array<struct<id: string, name: string, isActive: boolean>>>"


def read_survey_list(spark, path: str) -> DataFrame:
    """Surveys from list documents shaped ``{"result": {"elements": [...]}}``.

    Each file is one API page; ``explode`` turns the elements into rows.
    """
    docs = spark.read.schema(LIST_SCHEMA).option("multiLine", True).json(path)
    return (docs.select(F.explode("result.elements").alias("e"))
            .select(F.col("e.id").alias("survey_id"), F.col("e.isActive").alias("is_active")))


def write_survey_list(catalogue: DataFrame, path: str, page_size: int = 1000) -> None:
    """Write a catalogue as list documents, pages of about ``page_size`` surveys."""
    pages = max(1, -(-catalogue.count() // page_size))
    docs = catalogue.groupBy(F.pmod(F.xxhash64("survey_id"), F.lit(pages)).alias("page")).agg(
        F.collect_list(F.struct(F.col("survey_id").alias("id"), F.col("survey_id").alias("name"),
                                F.col("is_active").alias("isActive"))).alias("elements"))
    docs.select(F.struct("elements").alias("result")).write.mode("overwrite").json(path)


def active_surveys(surveys: DataFrame) -> DataFrame:
    """Only surveys flagged active (a null flag is not active)."""
    return surveys.filter(F.col("is_active") == F.lit(True))
