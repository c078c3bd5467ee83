"""Helpers shared by the training-data operators: words, landing tables, let-binding."""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ceasekit.sources.io import scratch_path

#: The white space that separates words, as a regular expression class body.
SPACE = r"\x20\x09-\x0D"


def split_words(text: Column) -> Column:
    """Words (maximal runs of non-space) of a text in order; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def count_words(text: Column) -> Column:
    """Number of words as a long; null gives 0."""
    return F.size(split_words(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once per row, also when ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back (a lineage cut that
    survives lost executors; each table is computed once)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files behind frames that are out of scope. It learns of
    them when the driver's garbage is collected, by default every half hour only."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def with_columns(df: DataFrame, added: dict[str, Column]) -> DataFrame:
    """``df`` plus the given columns; a column of the same name is replaced, whatever its case."""
    taken = {n.lower() for n in added}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken],
                     *[v.alias(k) for k, v in added.items()])


def packed(df: DataFrame, alias: str = "_row") -> Column:
    """All columns of ``df`` as one struct, so that working columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(alias)


def unpacked(df: DataFrame, columns: list[str], added: list[str] = (), alias: str = "_row") -> DataFrame:
    """Undo :func:`packed` and keep the ``added`` working columns (they win over a same name)."""
    taken = {n.lower() for n in added}
    return df.select(*[F.col(f"`{alias}`").getField(c).alias(c) for c in columns if c.lower() not in taken], *added)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
