"""Stored tables that are rewritten partition by partition under a manifest.

A root holds ``version=<name>`` folders, each a partitioned Parquet table, and ``_manifest/<n>`` tables that name, for every partition,
the versions it is read from; the largest finished one is in force. A rewrite stages the partitions it touches as a new version and
then writes the next manifest. Files are never changed or moved, so readers see the old state or the new one; a driver lost before
the swap leaves a staged version that ``swap`` can put in force later, and repeating a swap changes nothing. ``clean`` removes what no
manifest in force names."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIVE = "partition string, version string"


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    fs, path = _path(spark, folder)
    return fs.exists(path)


def children(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def current(spark: SparkSession, root: str) -> int:
    """Number of the manifest in force, 0 for none: the largest whose write was finished."""
    return max([int(n) for n in children(spark, f"{root}/_manifest") if exists(spark, f"{root}/_manifest/{n}/_SUCCESS")], default=0)


def live(spark: SparkSession, root: str) -> DataFrame:
    """(partition, version) in force; a partition is its folder below the version, as ``source=a/variable=b/year=2020``."""
    n = current(spark, root)
    return spark.read.schema(LIVE).parquet(f"{root}/_manifest/{n:08d}") if n else spark.createDataFrame([], LIVE)


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, changed) of the data files below a folder; a listing, no file is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def partition_of(path: Column) -> Column:
    return F.regexp_extract(path, r"/version=[^/]+/(.*)/[^/]+$", 1)


def held_in() -> Column:
    """The partition a row read from a version lies in."""
    return partition_of(F.col("_metadata.file_path"))


def read(spark: SparkSession, root: str, schema: T.StructType, partitions: Sequence[str] | None = None) -> DataFrame:
    """The rows in force, of all or the named partitions. Only their folders are listed and read; partition columns prune further."""
    rows = live(spark, root)
    if partitions is not None:
        rows = rows.where(F.col("partition").isin(list(partitions)))
    # one row a partition: the folders of the scan
    folders = [f"{root}/version={r.version}/{r.partition}" for r in rows.collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    kept = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    return spark.read.schema(kept).option("basePath", root).parquet(*folders).drop("version")


def stage(df: DataFrame, root: str, version: str, by: Sequence[str], touched: Sequence[str] = (), rows_per_file: int = 20_000_000) -> None:
    """Write ``df`` as a version that replaces the ``touched`` partitions and adds to any others, without putting it in force.

    What it replaces is written before the rows, so a finished version can always be swapped in. A version that was left unfinished
    is written anew; a finished one is kept, so that a repeated job goes on at the swap."""
    spark = df.sparkSession
    if exists(spark, f"{root}/version={version}/_SUCCESS"):
        return
    spark.createDataFrame([(p,) for p in touched], "partition string").coalesce(1).write.mode("overwrite").parquet(f"{root}/_replaces/{version}")
    (df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).option("compression", "zstd")
       .option("partitionOverwriteMode", "static").partitionBy(*by).parquet(f"{root}/version={version}"))


def pending(spark: SparkSession, root: str) -> list[str]:
    """Finished versions that no manifest has named yet: jobs lost between staging and swap."""
    seen = {r.version for k in children(spark, f"{root}/_manifest") for r in spark.read.schema(LIVE).parquet(f"{root}/_manifest/{k}").select("version").distinct().collect()}
    staged = [v.split("=", 1)[1] for v in children(spark, root) if v.startswith("version=")]
    return [v for v in staged if v not in seen and exists(spark, f"{root}/version={v}/_SUCCESS")]


def swap(spark: SparkSession, root: str, version: str) -> bool:
    """Put a staged version in force by writing the next manifest; False if it is unfinished or was in force before."""
    if version not in pending(spark, root):
        return False
    now, n = live(spark, root), current(spark, root)
    gone = spark.read.schema("partition string").parquet(f"{root}/_replaces/{version}")
    fresh = files(spark, f"{root}/version={version}").select(partition_of(F.col("path")).alias("partition")).distinct().withColumn("version", F.lit(version))
    new = now.join(gone, "partition", "left_anti").unionByName(fresh)
    # a number is taken once: a second writer that read the same manifest fails here and starts again from the one now in force
    new.coalesce(1).write.mode("errorifexists").parquet(f"{root}/_manifest/{n + 1:08d}")
    return True


def write(df: DataFrame, root: str, version: str, by: Sequence[str]) -> None:
    """Add rows as a version of their own, in force at once."""
    stage(df, root, version, by)
    swap(df.sparkSession, root, version)


def rewrite(spark: SparkSession, root: str, schema: T.StructType, version: str, touched: DataFrame, change: Callable[[DataFrame], DataFrame], by: Sequence[str]) -> list[str]:
    """Change the rows of the ``touched`` partitions (column partition, as ``held_in`` gives it) and swap the result in; the other partitions are not read.

    Rows that ``change`` moves to a partition outside ``touched`` are added to it. Returns the touched partitions."""
    if exists(spark, f"{root}/version={version}/_SUCCESS"):
        names = [r.partition for r in spark.read.parquet(f"{root}/_replaces/{version}").collect()]
    else:
        names = sorted(unquote(r.partition) for r in touched.select("partition").distinct().collect())
        if names:
            stage(change(read(spark, root, schema, names)), root, version, by, names)
    swap(spark, root, version)
    return names


def clean(spark: SparkSession, root: str) -> int:
    """Remove the folders and manifests that are no longer in force, unfinished versions too; returns how many folders went.

    To be run when no reader of an older manifest and no writer is at work."""
    kept, waiting, gone = {(r.version, r.partition) for r in live(spark, root).collect()}, pending(spark, root), 0
    for v in (x.split("=", 1)[1] for x in children(spark, root) if x.startswith("version=")):
        if v in waiting:
            continue
        dead = [""] if v not in {k for k, _ in kept} else [
            r.p for r in files(spark, f"{root}/version={v}").select(partition_of(F.col("path")).alias("p")).distinct().collect() if (v, r.p) not in kept]
        for p in dead:
            fs, path = _path(spark, f"{root}/version={v}/{p}")
            fs.delete(path, True)
            gone += 1
    for k in children(spark, f"{root}/_manifest"):
        if int(k) != current(spark, root):
            fs, path = _path(spark, f"{root}/_manifest/{k}")
            fs.delete(path, True)
    return gone
