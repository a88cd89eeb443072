"""Incremental ingestion of landed snapshots (O8, O10) with Structured Streaming and a partition ledger.

The reference stores a continuation token per survey and asks the source for
what is new since. Landed files play the source here: a file stream with a
checkpoint remembers which files were seen, ``trigger(availableNow=True)`` takes all that is there and stops, which is
the batch-job shape of the reference notebooks.

A snapshot may land again under the same timestamp and replaces the first one, and its files may be seen in several
batches. So a batch moves no data: it notes (timestamp, survey, folder, batch) of its files in the ledger beside the
checkpoint. When the stream has stopped, every folder that was noted later than it was last brought in is read whole and its
partition of the sink overwritten, once per run, however many batches its files span; then the ledger notes it as done. A run that
fails anywhere is repeated from the ledger: a batch's note is overwritten by the same note, a partition by the same rows.

Timestamp and survey are the partition columns as Spark reads them, so any survey id that can be written arrives as it is (the empty
id, like a null one, as null).
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from varloom.operators.derive import derive
from varloom.plans.all_surveys import derive_all_surveys
from varloom.sources.snapshots import PARTITIONED, parse_responses, read_folders

KEYS = ["process_timestamp", "survey_id"]
FOLDERS = 1_000  # folders brought in by one job
NOTES = "process_timestamp string, survey_id string, folder string, batch long"
FILES = "path string, modificationTime timestamp, length long, content binary, process_timestamp string, survey_id string"


def snapshot_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of responses from snapshot folders written by ``write_snapshot``."""
    lines = _reader(spark, PARTITIONED, max_files_per_trigger).text(root)
    return parse_responses(lines, F.col("process_timestamp"), F.col("survey_id"))


def _reader(spark: SparkSession, schema: str, max_files_per_trigger: int | None) -> DataStreamReader:
    reader = spark.readStream.schema(schema)
    return reader.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else reader


def _files(spark: SparkSession, root: str, max_files_per_trigger: int | None) -> DataFrame:
    """A stream of landed files, a row each: their content is not asked for, so it is not read."""
    files = _reader(spark, FILES, max_files_per_trigger).format("binaryFile").load(root)
    return files.select(*KEYS, F.col("_metadata.file_path").alias("path"))


class Ledger:
    """What was seen and what was brought in, by partition; kept beside the stream's checkpoint."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.root = spark, f"{checkpoint.rstrip('/')}/ledger"

    def _read(self, name: str) -> DataFrame:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], NOTES)
        return self.spark.read.schema(NOTES).option("recursiveFileLookup", True).parquet(f"{self.root}/{name}")

    def see(self, files: DataFrame, batch: int) -> None:
        """Note the folders of a batch's files. A batch that is run again replaces its own note."""
        folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
        (files.select(*KEYS, folder.alias("folder")).distinct().withColumn("batch", F.lit(batch).cast("long"))
         .coalesce(1).write.mode("overwrite").parquet(f"{self.root}/seen/{batch}"))

    def pending(self) -> list:
        """(timestamp, survey, folder, batch) of the folders seen since they were last brought in."""
        last = lambda name: self._read(name).groupBy("folder").agg(F.max("batch").alias(name), *(F.first(k).alias(k) for k in KEYS))
        done = last("done").select("folder", "done")
        todo = last("seen").join(done, "folder", "left").filter("done IS NULL OR seen > done")
        return todo.select(*KEYS, "folder", F.col("seen").alias("batch")).orderBy(*KEYS, "folder").collect()  # a row per folder of this run

    def done(self, folders: list) -> None:
        self.spark.createDataFrame(folders, NOTES).coalesce(1).write.mode("append").parquet(f"{self.root}/done")


def ingest_available(spark: SparkSession, landing_root: str, sink_path: str, checkpoint_path: str,
                     rules=None, mode: str = "intended", output: str = "map",
                     max_files_per_trigger: int | None = 10_000) -> int:
    """Bring the sink up to date with all landed files; return the rows written.

    The sink is partitioned by run timestamp and survey (read it with ``read_sink``). ``max_files_per_trigger`` bounds a batch of the
    stream, so a first run over a large landing zone is many batches, each safe to repeat.
    """
    derived = (lambda rows: derive(rows.drop("response"), rules, mode=mode, output=output)) if rules is not None else (lambda rows: rows)
    return _bring_in(spark, landing_root, sink_path, checkpoint_path, derived, max_files_per_trigger)


def ingest_all_surveys(spark: SparkSession, landing_root: str, sink_path: str, checkpoint_path: str, rules: DataFrame,
                       surveys: DataFrame | None = None, mode: str = "intended", output: str = "wide",
                       max_files_per_trigger: int | None = 10_000, failed: dict[str, str] | None = None) -> int:
    """As ``ingest_available``, each (active) survey with its own rules (O10); return the rows written.

    ``rules``, ``surveys``, ``output`` and ``failed`` as in ``derive_all_surveys``; responses of other surveys do not reach the sink.
    """
    derived = lambda rows: derive_all_surveys(rows.drop("response"), rules, surveys, mode=mode, output=output, failed=failed)
    return _bring_in(spark, landing_root, sink_path, checkpoint_path, derived, max_files_per_trigger)


def _bring_in(spark: SparkSession, landing_root: str, sink_path: str, checkpoint_path: str,
              derived: Callable[[DataFrame], DataFrame], max_files_per_trigger: int | None) -> int:
    ledger = Ledger(spark, checkpoint_path)
    files = _files(spark, landing_root, max_files_per_trigger)
    (files.writeStream.foreachBatch(ledger.see).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()).awaitTermination()
    todo = ledger.pending()
    written = 0
    for at in range(0, len(todo), FOLDERS):
        part = todo[at:at + FOLDERS]
        rows = read_folders(spark, landing_root, [unquote(r["folder"]) for r in part])
        seen = Observation()
        out = derived(rows).observe(seen, F.count(F.lit(1)).alias("rows"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*KEYS).parquet(sink_path)
        written += seen.get["rows"]
        ledger.done(part)
    return written


def read_sink(spark: SparkSession, sink_path: str) -> DataFrame:
    """The sink of an ingestion, survey ids as text whatever they look like."""
    found = spark.read.parquet(sink_path).schema
    types = {"process_timestamp": TimestampType(), "survey_id": StringType()}
    return spark.read.schema(StructType([StructField(f.name, types.get(f.name, f.dataType)) for f in found])).parquet(sink_path)
