"""Operator 1: mixing sources to target weights.

Sizes are summed per source, targets are filled up by weight under a cap, and each
document is emitted ``floor(rate)`` times plus one hash-seeded Bernoulli copy whose
probability is the fraction of the rate.

Defined cases: a null text has size 0; a null source is a source of its own, last in
order; a source of size 0 has target 0 and emits nothing; rows with the same id share
their draw (rows without an id draw by their text); an empty table gives an empty
result; a column named like an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ceasekit.llm.common import count_words, landed, packed, table, unpacked

WEIGHTS = (3, 1, 2)      # by rank of the source, repeating
TOTAL_RATIO = 1.5        # share of all sizes that the mix takes
CAP = 2                  # a target stops at CAP times its source's size
SEED = "mix-1"
#: Targets of at most this many sources (under 100 bytes each) are broadcast; more are joined by a salted shuffle.
BROADCAST_SOURCES = 100_000
SALTS = 64


def source_sizes(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """(source, source_size): words per source, pre-aggregated in each task."""
    return docs.select(F.col(f"`{source}`").alias("source"), count_words(F.col(f"`{text}`")).alias("size")) \
        .groupBy("source").agg(F.sum("size").alias("source_size"))


def cycled_weights(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Add ``weight``: the sources in code point order, null last, take the weights in turn.
    One row per source goes through the window, never a document."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    return sizes.withColumn("weight", F.get(cycle, F.pmod(rank, F.lit(len(weights)))))


def fill_targets(weighted: DataFrame, ratio: float = TOTAL_RATIO, cap: int = CAP) -> DataFrame:
    """Add ``target``: ``ratio`` of all sizes shared by weight; what lies above ``cap`` times a
    source's size is shared again by weight among the others until none is above.

    With the sources in order of cap / weight, ``level_i`` is what a unit of weight gets when all
    sources before i are full. It rises while sources are full and falls after, so the water
    level is its maximum and a target is min(cap, weight * level)."""
    full = F.col("source_size") * F.lit(cap)
    order = Window.orderBy((full / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum(full).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) * F.lit(float(ratio)) - before) / rest
    return weighted.withColumn("_level", level) \
        .withColumn("target", F.least(full.cast("double"), F.col("weight") * F.max("_level").over(whole))) \
        .drop("_level")


def draw(row_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the id only (without an id, on the text)."""
    key = F.coalesce(F.concat(F.lit("id:"), row_id.cast("string")), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def assign_copies(docs: DataFrame, targets: DataFrame, seed: str = SEED, source: str = "source",
                  text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` plus size, source_size, target, rate and copies. ``targets`` has one row per source."""
    few = targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    left = docs.select(packed(docs), F.col(f"`{source}`").alias("_source"))
    body, row_id = F.col("_row").getField(text), F.col("_row").getField(id_col)
    right = targets.select(F.col("source").alias("_of"), "source_size", "target")
    if few:
        joined = left.join(F.broadcast(right), F.col("_source").eqNullSafe(F.col("_of")), "left")
    else:
        left = left.withColumn("_salt", F.pmod(F.xxhash64(row_id, body), F.lit(SALTS)).cast("int"))
        right = right.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = left.join(right, F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_salt") == F.col("_copy")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = (draw(row_id, body, seed) < F.col("rate") - F.floor("rate")).cast("long")
    out = joined.withColumn("size", count_words(body)).withColumn("rate", rate) \
        .withColumn("copies", F.floor("rate") + extra)
    return unpacked(out, docs.columns, ["size", "source_size", "target", "rate", "copies"])


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, ratio: float = TOTAL_RATIO, cap: int = CAP,
                seed: str = SEED, source: str = "source", text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` plus size, source_size, target, rate and copies (how often the mix takes the row)."""
    targets = landed(fill_targets(cycled_weights(source_sizes(docs, source, text), weights), ratio, cap), "mix-targets")
    return assign_copies(docs, targets, seed, source, text, id_col)


def emit_copies(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, with its columns."""
    out = mix_sources(docs, **options)
    mixed = out.withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).drop("_n")
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, text, source,
         CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
l AS (SELECT *,
        (CAST((SELECT sum(source_size) FROM s) AS DOUBLE) * 1.5 - CAST(coalesce(sum(2 * source_size) OVER (
            ORDER BY (2 * source_size) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
        / CAST(sum(weight) OVER (
            ORDER BY (2 * source_size) / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
      FROM w),
t AS (SELECT source, source_size,
             least(CAST(2 * source_size AS DOUBLE), weight * (SELECT max(level) FROM l)) AS target FROM l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
             CAST(CAST('0x' || substr(md5('mix-1:' || coalesce('id:' || CAST(d.doc_id AS VARCHAR),
                                                      'text:' || md5(coalesce(d.text, '')))), 1, 13) AS BIGINT) AS DOUBLE)
               / 4503599627370496.0 AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM r
"""
