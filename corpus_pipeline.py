"""From raw documents to shuffled shards: quality rules, near-duplicates, benchmark
decontamination, source mix, shards. Each stage works on all rows that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ceasekit.llm.common import landed, table
from ceasekit.llm.decontaminate import decontaminated
from ceasekit.llm.mixing import emit_copies
from ceasekit.llm.near_dedup import one_per_class
from ceasekit.llm.quality import keep_good
from ceasekit.llm.sharding import shuffle_into_shards


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_per_class(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target of its source asks."""
    return emit_copies(docs)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot."""
    return shuffle_into_shards(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix_stage),
    ("shard", shard_stage),
]

#: Order MinHash and the Fisher-Yates shuffle have no SQL form; tests hold the stages against their operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
