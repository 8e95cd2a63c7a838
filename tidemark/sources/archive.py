"""The stored archive: partitioned Parquet scans, guarded writes and published marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import dedup_observations, drop_missing_codes, guard_dates, guard_nulls
from tidemark.schema import OBSERVATIONS, STORED
from tidemark.sources import manifest


def read_observations(spark: SparkSession, root: str) -> DataFrame:
    """The archive with its fixed columns; source, variable and year prune partitions.

    Under a root that has a manifest the versions in force are read, and nothing else is listed."""
    if manifest.current(spark, root):
        return manifest.read(spark, root, STORED)
    return spark.read.schema(STORED).parquet(root)


def read_table_group(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """A table whose columns grew over time, read as the union of its columns."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns: missing ones null, extra ones dropped, failed casts null."""
    cols = []
    for f in schema:
        c = F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def prepare_write(df: DataFrame, registry: DataFrame, now: Column, run_id: str | None = None) -> DataFrame:
    """What a write stores: guards, no-data removal, one row per key, fixed columns plus partitions."""
    if "ingest_run_id" not in df.columns:
        df = df.withColumn("ingest_run_id", F.lit(run_id))
    elif run_id:
        df = df.withColumn("ingest_run_id", F.coalesce("ingest_run_id", F.lit(run_id)))
    source = df["source"] if "source" in df.columns else F.split_part(F.col("site_uid"), F.lit(":"), F.lit(1))
    d = coerce(df.withColumn("_src", source), T.StructType(OBSERVATIONS.fields + [T.StructField("_src", T.StringType())]))
    d = dedup_observations(drop_missing_codes(guard_dates(guard_nulls(d), now), registry))
    return d.withColumn("year", F.year("datetime_utc")).withColumnRenamed("_src", "source")


def write_partitioned(df: DataFrame, root: str, mode: str = "append", rows_per_file: int = 20_000_000) -> None:
    """Write by source, variable and year.

    A rebalance, unlike a plain repartition on the partition columns, lets adaptive execution split
    a source that holds a third of all rows over many tasks and merge the small ones."""
    out = df.hint("rebalance", F.col("source"), F.col("variable"), F.col("year"))
    (out.write.mode(mode).option("maxRecordsPerFile", rows_per_file).option("compression", "zstd")
        .partitionBy("source", "variable", "year").parquet(root))


def append_observations(df: DataFrame, registry: DataFrame, now: Column, root: str, run_id: str) -> None:
    write_partitioned(prepare_write(df, registry, now, run_id), root)


def publish_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def publish_json(df: DataFrame, path: str) -> None:
    """JSON lines; not-a-number becomes null."""
    cols = [F.nanvl(F.col(n), F.lit(None).cast(t)).alias(n) if t in ("double", "float") else F.col(n) for n, t in df.dtypes]
    df.select(*cols).write.mode("overwrite").json(path)
