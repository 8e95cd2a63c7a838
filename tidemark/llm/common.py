"""Shared steps of the corpus operators: stored intermediates and Arrow batches over text."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.session import ensure_checkpoint_dir

#: Folders that ``stored`` has written in this driver, for a caller that knows when nothing reads them any more.
WRITTEN: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table, below the checkpoint folder that all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here, so a lost executor repeats nothing before it."""
    path = shared_path(df.sparkSession, name)
    WRITTEN.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Remove the files of a ``stored`` table that nothing reads any more."""
    drop_paths(df.sparkSession, {f.rsplit("/", 1)[0] for f in df.inputFiles()})


def drop_paths(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def released(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose results are stored; it does so when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def give_back() -> None:
    """Hand memory that is free again to the system: workers are used by one stage after the other, and each would keep its peak."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without this call
        ctypes.CDLL(None).malloc_trim(0)


def in_slices(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to some rows each, so that a worker holds few texts as Python objects at a time; free memory goes back at
    the end."""
    for b in batches:
        for s in range(0, b.num_rows, rows):
            yield b.slice(s, rows)
    b = None  # noqa: F841
    give_back()


def add_columns(df: DataFrame, added: list[T.StructField], make: Callable[[dict[str, list]], dict], needs: list[str], left_out: Iterable[str] = ()) -> DataFrame:
    """Columns computed per Arrow batch. Other columns pass through, but for those left out; one that bears the name of a new column
    is replaced."""
    new = {f.name.lower() for f in added} | {c.lower() for c in left_out}
    keep = [c for c in df.columns if c.lower() not in new]
    src = {c: [x for x in df.columns if x.lower() == c.lower()][0] for c in needs}
    schema = T.StructType([df.schema[c] for c in keep] + added)
    kinds = [to_arrow_type(f.dataType) for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches):
            got = make({c: b.column(x).to_pylist() for c, x in src.items()})
            cols = [b.column(c) for c in keep] + [
                v if isinstance(v := got[f.name], pa.Array) else pa.array(v, type=k) for f, k in zip(added, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, *(f.name for f in added)])

    return df.mapInArrow(run, schema)


def field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, T._parse_datatype_string(kind) if "<" in kind else getattr(T, {
        "long": "LongType", "int": "IntegerType", "string": "StringType", "boolean": "BooleanType", "binary": "BinaryType",
        "double": "DoubleType"}[kind])())


def numbered_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``_seq``: 0, and where a key stands on rows of different texts the rank of the text, so that (key, _seq) names one text.

    Rows that repeat key and text share it. Keys are counted first (ids only); the ranks are computed only where some key repeats."""
    repeats = df.groupBy(key).count().where("count > 1").select(F.col(key).alias("_key"))
    if repeats.isEmpty():
        return df.withColumn("_seq", F.lit(0))
    hashed = df.withColumn("_hash", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    rank = F.dense_rank().over(Window.partitionBy(key).orderBy("_hash")) - 1
    small = hashed.join(repeats, F.col(key).eqNullSafe(F.col("_key")), "left_semi").select(key, "_hash").distinct().withColumn("_seq", rank)
    small = small.select(F.col(key).alias("_key"), F.col("_hash").alias("_of"), "_seq")
    out = hashed.join(small, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_hash") == F.col("_of")), "left")
    return out.withColumn("_seq", F.coalesce("_seq", F.lit(0))).drop("_hash", "_key", "_of")


def numbered(df: DataFrame, group: str, order: list[str], cuts: list[Column], name: str) -> DataFrame:
    """``df``, written to the shared folder, with ``_i``: each row's place from 0 in its group by ``order``, nulls first.

    Rows are sorted in ranges of (group, cuts), so a group of any size is dealt out; ``cuts`` must follow ``order`` and may be
    shorter (a prefix of a long text). Places are counted in the stream of a range. A group that goes on in the next range gets the
    rows before it added: one row a range, made known to the driver, says with which group a range begins and ends. Columns ``_part``
    and ``_i`` of the input are replaced."""
    spark, free = df.sparkSession, df.drop("_part", "_i")
    keys = [F.col(c).asc_nulls_first() for c in [group, *order]]
    dealt = free.repartitionByRange(parallelism(spark), F.col(group).asc_nulls_first(), *[c.asc_nulls_first() for c in cuts])
    dealt = dealt.sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at = None, -1
        for b in in_slices(batches):
            places = []
            for g in b.column(group).to_pylist():
                last, at = g, at + 1 if g == last else 0
                places.append(at)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(places, pa.int64())], names=[*b.schema.names, "_i"])

    out = stored(dealt.mapInArrow(count, T.StructType([*dealt.schema.fields, T.StructField("_i", T.LongType())])), name)
    at = F.struct(F.col(group).isNotNull(), F.col(group), "_i")
    ends = out.groupBy("_part").agg(F.min_by(F.struct(F.col(group).alias("g")), at).alias("head"), F.max_by(F.struct(F.col(group).alias("g"), "_i"), at).alias("tail"))
    moved, before, held = [], None, 0
    for r in sorted(ends.collect()):
        start = held if before is not None and before == (r.head.g,) else 0
        if start:
            moved.append((r._part, r.head.g, start))
        held, before = r.tail._i + 1 + (start if r.head.g == r.tail.g else 0), (r.tail.g,)
    if not moved:
        return out.drop("_part")
    kind = T.StructType([T.StructField("_in_part", T.IntegerType()), T.StructField("_in_group", df.schema[group].dataType), T.StructField("_add", T.LongType())])
    adds = F.broadcast(spark.createDataFrame(moved, kind))
    joined = out.join(adds, (F.col("_part") == F.col("_in_part")) & F.col(group).eqNullSafe(F.col("_in_group")), "left")
    return joined.withColumn("_i", F.col("_i") + F.coalesce("_add", F.lit(0))).drop("_part", "_in_part", "_in_group", "_add")


def text_of(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
