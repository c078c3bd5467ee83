"""Dedup, existence flags, same-month joins, aligned unions, key-set comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ceasekit.functions.dates import month_start


def _cols(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def keep_first(df: DataFrame, key, order, tie_break: bool = True) -> DataFrame:
    """Keep one row per ``key``: the first by ``order`` (ascending).

    ``row_number() = 1`` is planned with a partial ``WindowGroupLimit`` before the
    shuffle, so each map task ships at most one row per key (a hot key does not
    land whole in one task). With ``tie_break`` every other column is appended to
    the order, which makes the choice total and repeatable.
    """
    key = _cols(key)
    order = _cols(order)
    names = {c for c in key + order if isinstance(c, str)}
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in names] if tie_break else []
    w = Window.partitionBy(*key).orderBy(*order, *rest)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def existence_flag(left: DataFrame, right: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """``left`` plus a 0/1 column: 1 when ``right`` has a row with the same keys.

    The right side is reduced to distinct keys first (partial aggregation, so a key
    repeated a million times ships once per map task) and the left row count is kept.
    """
    on = _cols(on)
    flags = right.select(*on).distinct().withColumn(name, F.lit(1))
    return left.join(flags, on, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("int"))


def same_month_join(facts: DataFrame, obs: DataFrame, key: str, date_col: str, month_col: str,
                    how: str = "inner") -> DataFrame:
    """Rows of ``facts`` whose date is in the customer's observation month.

    An equi-join on (key, month start) instead of ``year = year AND month = month``
    after a join on the key: both keys go into the join, and the month key is a
    partition column when facts are stored by month.
    """
    f = facts.withColumn("_m", month_start(date_col))
    return f.join(obs.withColumnRenamed(month_col, "_m"), [key, "_m"], how) \
        .withColumn(month_col, F.col("_m")).drop("_m")


def union_aligned(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """UNION ALL after selecting the same columns in the same order (by name)."""
    out = None
    for f in frames:
        f = f.select(*columns)
        out = f if out is None else out.unionByName(f)
    return out


def key_set_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Sizes of only-in-a, only-in-b and in-both for the distinct keys of two frames.

    One full outer join of distinct keys instead of collecting both key sets.
    """
    ka = a.select(key).distinct().withColumn("_a", F.lit(1))
    kb = b.select(key).distinct().withColumn("_b", F.lit(1))
    j = ka.join(kb, key, "full")
    return j.agg(
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNull()).alias("only_in_first"),
        F.count_if(F.col("_a").isNull() & F.col("_b").isNotNull()).alias("only_in_last"),
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("in_both"),
    )
