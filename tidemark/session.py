"""Session defaults for running the archive jobs."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC clock and adaptive execution; a cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names; a private one only where none is set."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if named:
        sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="spark-ckpt-")
    sc.setCheckpointDir(folder)
    return folder
