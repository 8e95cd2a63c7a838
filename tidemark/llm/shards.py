"""Shards by jump consistent hashing: no ring table, and one more shard takes rows only into itself.

Written in Spark expressions alone. The generator is the published 64-bit linear congruential one; Spark's bigint raises on
overflow, so the product modulo 2**64 is put together from parts of 22 bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_of

# Fixed value: the multiplier of jump consistent hashing.
STEP = 2862933555777941757
LOW = (1 << 22) - 1


def next_state(key: Column) -> Column:
    """key * STEP + 1 modulo 2**64, as a signed bigint."""
    m = [STEP & LOW, STEP >> 22 & LOW, STEP >> 44]
    k0, k1, k2 = key.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(key, 22).bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(key, 44)
    low = k0 * m[0] + 1
    mid = k0 * m[1] + k1 * m[0] + F.shiftright(low, 22)
    high = k0 * m[2] + k1 * m[1] + k2 * m[0] + F.shiftright(mid, 22)
    return F.shiftleft(high.bitwiseAND(F.lit((1 << 20) - 1)), 44).bitwiseOR(F.shiftleft(mid.bitwiseAND(F.lit(LOW)), 22)).bitwiseOR(low.bitwiseAND(F.lit(LOW)))


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of a bigint key; null keys count as 0. A jump moves at least one shard on, so ``shards`` steps always suffice."""
    start = F.struct(F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint")).alias("key"), F.lit(-1).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("to"))

    def step(state: Column, _: Column) -> Column:
        made = F.struct(next_state(state["key"]).alias("key"), state["to"].alias("at"))
        jump = F.transform(F.array(made), lambda s: F.struct(
            s["key"].alias("key"), s["at"].alias("at"),
            F.floor((s["at"] + 1) * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(s["key"], 33) + 1).cast("double"))).cast("bigint").alias("to")))
        return F.when(state["to"] < shards, F.element_at(jump, 1)).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda s: s["at"].cast("int"))


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", rows_per_part: int = 200_000) -> DataFrame:
    """(key, size, text_crc32, shard, slot, grown_shard) for every row.

    The key and the number of shards alone decide the shard, so copies of a row share it. Slots run gapless from 0 in each shard.
    They are counted in two passes: ranks inside parts of a shard (by a hash of the row), added to the totals of the parts
    before; no task holds a shard. Ties (repeated rows) get slots of their own. Null text is empty, a null key goes where 0 goes."""
    body = text_of(text)
    rows = docs.select(
        F.col(key), (F.octet_length(body) + 16).cast("bigint").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        jump_shard(F.col(key), shards).alias("shard"), jump_shard(F.col(key), shards + 1).alias("grown_shard"))
    parts = max(1, -(-docs.count() // rows_per_part))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(key, "text_crc32", "size"), F.lit(parts)))
    sums = rows.groupBy("shard", "_part").count()
    before = F.sum("count").over(Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("shard", "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("shard", "_part").orderBy(key, "text_crc32", "size")) - 1
    ranked = rows.withColumn("_rank", rank).join(sums, ["shard", "_part"])
    return ranked.select(key, "size", "text_crc32", "shard", (F.col("_before") + F.col("_rank")).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id", files: int = 1) -> None:
    """The rows themselves as Parquet, one folder a shard with up to ``files`` files for each."""
    dealt = docs.withColumn("shard", jump_shard(F.col(key), shards)).withColumn("_file", F.pmod(F.xxhash64(*docs.columns), F.lit(files)))
    dealt.repartition(shards * files, "shard", "_file").drop("_file").write.partitionBy("shard").parquet(path)
