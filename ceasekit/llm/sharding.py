"""Operator 2: two-pass external shuffle into shards.

Pass 1 scatters the rows into buckets that fit in memory by a seeded hash of their
content. Pass 2 puts the rows of each bucket in a canonical order and permutes them by a
seeded Fisher-Yates shuffle. The buckets, in order, form one shuffled sequence, which is
cut into shards of equal row counts (law ``rows``): the counts differ by one at most.

Rows equal in every column are interchangeable. Up to ``COPIES`` of them share a bucket; of a larger group
one row is kept with its count, and its copies are dealt out anew, each by its number, so that no group
of any size fills a bucket or a task.

Defined cases: rows with nulls, empty texts or repeated ids are rows like any other; an empty table gives
an empty result; a column named like an added one is replaced. The result depends on the
rows and the seed only, not on how the input is partitioned.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ceasekit.llm.common import landed, packed, table, unpacked

SHARDS = 24
SEED = 20_240_601
BUCKET_BYTES = 16 << 20   # expected text bytes of a bucket
COPIES = 1_000            # equal rows that may share a bucket; copies that a task deals out at once


def record_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(8)


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of range(n): for i from n - 1 down, swap i with a drawn j <= i."""
    order = np.arange(n)
    draws = np.random.Generator(np.random.PCG64([seed, bucket])).random(n)
    for i in range(n - 1, 0, -1):
        j = int(draws[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return order


def shuffle_bucket(seed: int):
    def run(rows: pa.Table) -> pa.Table:
        # rows with equal keys are equal rows, so that the canonical order is unique
        rows = rows.sort_by([("_key", "ascending"), ("_key2", "ascending")])
        rows = rows.take(pa.array(fisher_yates(len(rows), seed, rows["_bucket"][0].as_py())))
        return pa.table({"_bucket": rows["_bucket"], "_at": pa.array(np.arange(len(rows))), "_row": rows["_row"]})
    return run


def dealt_out(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` with large groups of equal rows spread over all buckets by the number of the copy."""
    key = ["_key", "_key2"]
    many = landed(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_copies")).where(F.col("_copies") > COPIES), "shard-copies")
    if many.isEmpty():
        return rows
    one = rows.join(many, key).groupBy(*key).agg(F.first("_row").alias("_row"), F.first("_copies").alias("_copies"))
    chunk = F.explode(F.sequence(F.lit(0), F.expr(f"(_copies - 1) div {COPIES}")))
    chunks = one.withColumn("_chunk", chunk).repartition("_key", "_key2", "_chunk")
    last = F.least(F.col("_copies"), (F.col("_chunk") + 1) * COPIES) - 1
    copies = chunks.withColumn("_number", F.explode(F.sequence(F.col("_chunk") * COPIES, last)))
    again = copies.select(F.pmod(F.xxhash64("_key", "_number"), F.lit(buckets)).cast("long").alias("_bucket"), *key, "_row")
    return rows.join(many, key, "left_anti").select("_bucket", *key, "_row").unionByName(again)


def shuffle_into_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
                        text: str = "text") -> DataFrame:
    """``docs`` plus law ('rows'), shard (0 to ``shards`` - 1) and slot (position in the shard, from 0).

    One aggregate gives the number of buckets, a second one the rows per bucket. Those counts
    (one row per bucket of ``bucket_bytes``) become the buckets' offsets in the sequence and are
    joined to the shuffled rows on the bucket they are partitioned by."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    keys = F.xxhash64(F.lit(seed), *cols), F.xxhash64(F.lit(seed + 1), *cols)
    total = docs.agg(F.sum(record_bytes(F.col(f"`{text}`"))).alias("b")).first().b or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    spread = F.pmod(keys[0], F.lit(buckets)).cast("long")
    scattered = dealt_out(docs.select(spread.alias("_bucket"), keys[0].alias("_key"), keys[1].alias("_key2"), packed(docs)), buckets)
    counts = scattered.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    ordered = Window.orderBy("_bucket")
    offsets = landed(counts.select("_bucket", (F.sum("_n").over(ordered) - F.col("_n")).alias("_offset"),
                                   F.sum("_n").over(Window.partitionBy()).alias("_total")), "shard-offsets")
    schema = T.StructType([T.StructField("_bucket", T.LongType()), T.StructField("_at", T.LongType()),
                           scattered.schema["_row"]])
    mixed = scattered.groupBy("_bucket").applyInArrow(shuffle_bucket(seed), schema)
    at = F.col("_offset") + F.col("_at")
    # the first shards get one row more: shard k starts at k * (total div shards) + min(k, total mod shards)
    small, extra = F.expr(f"_total div {shards}"), F.col("_total") % shards
    edge = extra * (small + 1)
    shard = F.when(at < edge, F.expr(f"(_offset + _at) div (_total div {shards} + 1)")) \
        .otherwise(extra + F.expr(f"(_offset + _at - (_total % {shards}) * (_total div {shards} + 1)) div greatest(_total div {shards}, 1)"))
    first = shard * small + F.least(shard, extra)
    placed = mixed.join(offsets, "_bucket").select("_row", F.lit("rows").alias("law"), shard.cast("int").alias("shard"),
                                                   (at - first).cast("long").alias("slot"))
    return unpacked(placed, docs.columns, ["law", "shard", "slot"])


def write_shards(docs: DataFrame, path: str, **options) -> str:
    """Shuffle and write one folder per shard, ordered by slot within each of its files."""
    shuffle_into_shards(docs, **options).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(path)
    return path


def op2_shard(spark, sf_dir: str) -> DataFrame:
    out = shuffle_into_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", record_bytes(F.col("text")).alias("size"),
                      F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), "law", "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
