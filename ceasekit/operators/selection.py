"""Exact order statistics of integer keys for any number of groups, without a sort or a window per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ceasekit.sources.io import scratch_path

KEY_BITS, DIGIT_BITS = 60, 20


def same(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    """Null-safe equality of the columns, so that a null is a group of its own."""
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in columns], F.lit(True))


def ranked_keys(df: DataFrame, by: Sequence[str], key: str, shares: Mapping[str, float]) -> DataFrame:
    """(by, one column per share): in each group the k-th least key, k = floor(share * rows + 0.5); -1 if k is 0.

    Keys are hashes below 2^60. First, rows are counted per (group, top 20 bits) with a partial aggregate, and
    running counts over these cells, 2^20 per group at most, tell which cell holds rank k. Then only the rows
    of those cells, about a millionth of the group each, are numbered in the order of their keys. A group with
    a third of all rows is neither sorted nor in one task. The result, one row per group, is written and read
    back."""
    spark, by = df.sparkSession, list(by)
    cell = F.shiftright("_key", KEY_BITS - DIGIT_BITS).alias("_cell")
    rows = df.select(*[F.col(c) for c in by], F.col(key).alias("_key")).where(F.col("_key").isNotNull()).select("*", cell)
    counts = rows.groupBy(*by, "_cell").agg(F.count(F.lit(1)).alias("_c"))
    group = Window.partitionBy(*by)
    upto = group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("_upto", F.sum("_c").over(upto)).withColumn("_n", F.sum("_c").over(group))
    names = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(s)).alias("share")) for n, s in shares.items()]))
    need = F.floor(F.col("_want.share") * F.col("_n") + 0.5).cast("long")
    holds = (F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_c") < F.greatest("_need", F.lit(1)))
    at = counts.select("*", names.alias("_want")).withColumn("_need", need).where(holds).select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], F.col("_want.name").alias("_name"), F.col("_cell").alias("_in"), "_need", (F.col("_need") - F.col("_upto") + F.col("_c")).alias("_rank"))
    here = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)], F.col("_cell") == F.col("_in"))
    inside = rows.join(at, here).select(*by, "_name", "_need", "_rank", "_key")
    numbered = inside.withColumn("_at", F.row_number().over(Window.partitionBy(*by, "_name").orderBy("_key")))
    found = numbered.where(F.col("_at") == F.greatest("_rank", F.lit(1)))
    limit = F.when(F.col("_need") == 0, -1).otherwise(F.col("_key"))
    out = found.groupBy(*by).agg(*[F.max(F.when(F.col("_name") == n, limit)).alias(n) for n in shares])
    path = scratch_path(spark, "ranked-keys")
    out.write.parquet(path)
    return spark.read.schema(out.schema).parquet(path)
