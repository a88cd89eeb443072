"""Spark session and shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "varloom", shuffle_partitions: int | None = None) -> SparkSession:
    """A session tuned for this library; reuses an active one if present."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Where neither is set a
    private temporary folder is made, on a local master only: on a cluster each executor would
    write to a disk of its own.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="varloom-ckpt-")
        sc.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/varloom/{name}-{uuid.uuid4().hex[:12]}"
