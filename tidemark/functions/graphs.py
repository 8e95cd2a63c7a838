"""Connected components of an edge table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir


def _round(df: DataFrame, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(df: DataFrame, path: str) -> None:
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _print(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, root): the smallest node reachable from each node of an edge; a root stands on no row of its own.

    Alternating stars: every node first hands its larger neighbours to the smallest node it knows, then
    hands all smaller ones over too, which hooks whole trees to their roots whatever the order of ids.
    A hub's smallest neighbour is a combinable aggregate, and adaptive execution splits a hub in the
    join back. Each round is written to the shared folder and read back, so neither lineage nor size
    estimates pile up; rounds go on until the edges stay the same. Null ends and loops are left out."""
    spark = edges.sparkSession
    folder = f"{(spark.conf.get('spark.checkpoint.dir', None) or ensure_checkpoint_dir(spark)).rstrip('/')}/components-{uuid.uuid4().hex}"
    e = _round(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), folder, "r0")
    seen, k = _print(e), 0
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.greatest("v", "m").alias("u"), F.col("m").alias("v")).where("u != v")
        k += 1
        e = _round(small.union(low.select("u", F.col("m").alias("v"))).distinct(), folder, f"r{k}")
        now = _print(e)
        _delete(e, f"{folder}/r{k - 1}")
        if now == seen:
            return e.select(F.col("u").alias("id"), F.col("v").alias("root"))
        seen = now
