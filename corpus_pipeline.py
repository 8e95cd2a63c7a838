"""The corpus pipeline: quality rules, near-duplicates, repeated passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; ``run`` writes every stage's result as Parquet
in the shared folder and reads it again."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import contamination, neardup, packing, quality, suffixes
from tidemark.llm.common import WRITTEN, drop_paths, stored


_left: list[str] = []


def after_previous(stage):
    """The stage, once the intermediate tables of the one before are removed: its result has been written by then."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_paths(spark, _left)
        before = len(WRITTEN)
        out = stage(spark, docs, sf_dir)
        _left[:] = WRITTEN[before:]
        return out

    return run_stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go from the texts, and documents that fail the counts or lose too much go whole."""
    return quality.reject(docs)


@after_previous
def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 over five-word shingles stays."""
    return neardup.representatives(docs)


@after_previous
def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that stand earlier go from the texts."""
    return suffixes.without_repeats(docs)


@after_previous
def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item go."""
    return contamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids."""
    import public_tokenizers

    pieces = packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_stage), ("minhash_neardup", neardup_stage), ("suffix_dedup", suffix_stage),
    ("decontamination", benchmark_stage), ("packing", packing_stage)]

#: SQL cannot express tokenisation; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
