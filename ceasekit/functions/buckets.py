"""Bucket rules used by features and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ceasekit.functions.dates import days_in_month


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed bucket bounds of the out-of-contract-days feature.
OOC_LOW, OOC_HIGH = -100, 50


def ooc_bucket_columns(c="ooc_days") -> list[Column]:
    """Four 0/1 columns. NaN compares greater than any number in Spark, so a NaN
    lands in ``over_50`` and not in ``missing`` (only null is missing)."""
    x = _c(c)
    return [
        F.when(x < OOC_LOW, 1).otherwise(0).cast("int").alias("ooc_bucket_under_minus100"),
        F.when(x.between(OOC_LOW, OOC_HIGH), 1).otherwise(0).cast("int").alias("ooc_bucket_minus100_to_50"),
        F.when(x > OOC_HIGH, 1).otherwise(0).cast("int").alias("ooc_bucket_over_50"),
        F.when(x.isNull(), 1).otherwise(0).cast("int").alias("ooc_bucket_missing"),
    ]


def usage_day_columns(usage_days, behav_win) -> list[Column]:
    """Usage-day buckets of the observation month (mutually exclusive)."""
    u = _c(usage_days)
    missed = days_in_month(behav_win) - u
    return [
        F.when(u == 0, 1).otherwise(0).cast("int").alias("usage_days_bucket_no_usage"),
        F.when((missed == 0) & (u > 0), 1).otherwise(0).cast("int").alias("usage_days_bucket_full_usage"),
        F.when((missed >= 1) & (missed <= 14), 1).otherwise(0).cast("int").alias("usage_days_bucket_missed_1_to_14"),
        F.when((missed > 14) & (u > 0), 1).otherwise(0).cast("int").alias("usage_days_bucket_missed_15_plus"),
    ]


USAGE_BUCKET_ORDER = ("no_usage", "full_usage", "missed_1_to_14", "missed_15_plus")


def usage_bucket_label(usage_days, behav_win) -> Column:
    u = _c(usage_days)
    missed = days_in_month(behav_win) - u
    return (F.when(u == 0, "no_usage").when(missed == 0, "full_usage")
            .when((missed >= 1) & (missed <= 14), "missed_1_to_14").otherwise("missed_15_plus"))


# Line-speed buckets by tens up to 100-108 (fixed rule of the study).
LINE_SPEED_BUCKETS = tuple((lo, lo + 9, f"{lo}-{lo + 9}") for lo in range(0, 100, 10)) + ((100, 108, "100-108"),)
LINE_SPEED_ORDER = ("Below 0",) + tuple(b[2] for b in LINE_SPEED_BUCKETS) + ("Over 108", "Missing")


def line_speed_bucket(c="line_speed", compat: bool = False) -> Column:
    """Fixed line-speed bucket.

    Default: half-open ``[lo, lo+10)`` so 9.5 falls in 0-9 and 108.5 in 100-108;
    negatives get ``Below 0``. ``compat=True`` keeps the literal inclusive-integer
    rule where 9.5 and negatives fall through to ``Over 108``.
    """
    x = _c(c)
    expr = F.when(x.isNull(), "Missing")
    if not compat:
        expr = expr.when(x < 0, "Below 0")
    for lo, hi, label in LINE_SPEED_BUCKETS:
        cond = x.between(lo, hi) if compat else (x >= lo) & (x < hi + 1)
        expr = expr.when(cond, label)
    return expr.otherwise("Over 108")


def line_speed_bucket_order(label) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in LINE_SPEED_ORDER]), _c(label)).cast("int")


def edge_text(x, digits: int) -> Column:
    """Edge number as text with ``digits`` decimals (half away from zero, via DECIMAL)."""
    return _c(x).cast("decimal(38,10)").cast(f"decimal(38,{digits})").cast("string")


def quantile_bucket(x, edges: Sequence, digits: int) -> tuple[Column, Column]:
    """Label and ordinal for value ``x`` given ascending edge Columns.

    Labels ``0-e1``, ``e1-e2``, ..., ``e9+``, ``Missing``; the first matching
    bucket wins, so duplicate edges leave a bucket empty.
    """
    x = _c(x)
    t = [edge_text(e, digits) for e in edges]
    label = F.when(x.isNull(), F.lit("Missing"))
    order = F.when(x.isNull(), F.lit(len(edges) + 2))
    for i, e in enumerate(edges):
        lo = F.lit("0") if i == 0 else t[i - 1]
        label = label.when(x <= e, F.concat(lo, F.lit("-"), t[i]))
        order = order.when(x <= e, F.lit(i + 1))
    label = label.otherwise(F.concat(t[-1], F.lit("+")))
    order = order.otherwise(F.lit(len(edges) + 1))
    return label, order.cast("int")
