"""Dense codes for any number of categories, and sparse one-hot vectors from them.

The dictionary is a table: no list of values is collected, and no column is made per value. Codes come from
a prefix scan over the distinct values (range partitions and their offsets).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ceasekit.operators.prefix import landed, prefix_scan


def category_codes(rows: DataFrame, groups: Mapping[str, Column]) -> DataFrame:
    """(category_group, value, code): the distinct non-null values of every group (as text) in order, with codes
    0, 1, ... within the group. All groups come from one pass and one partial-aggregate distinct, so a value of a
    third of all rows is one row per task."""
    tagged = [F.struct(F.lit(g).alias("category_group"), c.cast("string").alias("value")) for g, c in groups.items()]
    pairs = rows.select(F.inline(F.array(*tagged))).where(F.col("value").isNotNull()).distinct()
    numbered = prefix_scan(pairs, ["category_group", "value"], {"_at": ("sum", F.lit(1).cast("long"))})
    numbered = landed(numbered, "category-codes")
    first = numbered.groupBy(F.col("category_group").alias("_g")).agg(F.min("_at").alias("_first"))       # one row per group
    return numbered.join(first, F.col("category_group") == F.col("_g")).select("category_group", "value", (F.col("_at") - F.col("_first")).alias("code"))


def with_codes(rows: DataFrame, groups: Mapping[str, Column], codes: DataFrame, suffix: str = "_code") -> DataFrame:
    """``rows`` with a column ``<group>_code`` per group; null where the value is null or unknown. A small
    dictionary is broadcast by Spark; for a large one the join shuffles, and hot values are split (AQE skew join)."""
    out = rows.select("*", *[c.cast("string").alias(f"_v_{g}") for g, c in groups.items()])
    for g in groups:
        own = codes.where(F.col("category_group") == g).select(F.col("value").alias(f"_k_{g}"), F.col("code").alias(f"{g}{suffix}"))
        out = out.join(own, F.col(f"_v_{g}") == F.col(f"_k_{g}"), "left").drop(f"_k_{g}", f"_v_{g}")
    return out


def one_hot_vectors(coded: DataFrame, groups: Sequence[str], codes: DataFrame, suffix: str = "_code") -> DataFrame:
    """A sparse vector column ``<group>_vector`` per code column, as long as the group has categories; a null code
    is all zeros. The encoder learns the lengths from the dictionary, not from the rows."""
    ins, outs = [f"_i_{g}" for g in groups], [f"{g}_vector" for g in groups]
    sizes = codes.groupBy().agg(*[F.max(F.when(F.col("category_group") == g, F.col("code"))).alias(i) for g, i in zip(groups, ins, strict=True)])
    model = OneHotEncoder(inputCols=ins, outputCols=outs, handleInvalid="keep", dropLast=True).fit(
        sizes.select(*[F.coalesce(F.col(i), F.lit(0)).cast("double").alias(i) for i in ins]))
    beyond = [size for size in model.categorySizes]                 # the encoder gives all zeros to the code after the last
    kept = coded.select("*", *[F.coalesce(F.col(f"{g}{suffix}"), F.lit(n)).cast("double").alias(i) for g, i, n in zip(groups, ins, beyond, strict=True)])
    return model.transform(kept).drop(*ins)
