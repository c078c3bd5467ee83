"""Least-squares polynomials of many groups in one scan, from Chebyshev moments.

With x scaled to [-1, 1] per group, T_i T_j = (T_{i+j} + T_{|i-j|}) / 2, so the normal equations of degree d need
only the sums of w T_k for k up to 2d and of w y T_k for k up to d. These are plain sums: mergeable, and as many
per group whatever its rows. Only one row per group is solved.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _t(k: int, x: Column) -> Column:
    return F.cos(F.lit(k) * F.acos(F.greatest(F.least(x, F.lit(1.0)), F.lit(-1.0))))


def _scaled(x: Column, lo: Column, hi: Column) -> Column:
    return F.when(hi > lo, (2 * x - lo - hi) / (hi - lo)).otherwise(F.lit(0.0))


def fit_groups(points: DataFrame, by: Sequence[str], x: str, y: str, degree: int, weight: str | None = None) -> DataFrame:
    """(by, n_points, x_min, x_max, coefficients, r2): the polynomial of every group as Chebyshev coefficients on
    [x_min, x_max]. Rows with a null (or NaN) x, y or weight are left out; a null key is a group; a group with no
    more distinct x than the degree has null coefficients. Two passes: the range of x, then the moments."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = points.select(*by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), w.alias("_w"))
    known = [F.col(c).isNotNull() & ~F.isnan(c) for c in ("_x", "_y", "_w")]
    rows = rows.where(known[0] & known[1] & known[2])
    spans = rows.groupBy(*by).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.approx_count_distinct("_x").alias("_d"))
    spans = spans.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], "_lo", "_hi", "_d")
    on = F.lit(True)
    for i, c in enumerate(by):
        on = on & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    placed = rows.join(spans, on).withColumn("_s", _scaled(F.col("_x"), F.col("_lo"), F.col("_hi")))
    sums = placed.groupBy(*by, "_lo", "_hi", "_d").agg(
        F.count(F.lit(1)).alias("n_points"), F.array(*[F.sum(F.col("_w") * _t(k, F.col("_s"))) for k in range(2 * degree + 1)]).alias("_m"),
        F.array(*[F.sum(F.col("_w") * F.col("_y") * _t(k, F.col("_s"))) for k in range(degree + 1)]).alias("_v"),
        F.sum(F.col("_w") * F.col("_y") * F.col("_y")).alias("_yy"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        i, j = np.indices((degree + 1, degree + 1))
        for pdf in batches:
            coefficients, r2 = [], []
            for m, v, yy in zip(pdf["_m"], pdf["_v"], pdf["_yy"], strict=True):
                m, v = np.asarray(m, float), np.asarray(v, float)
                gram = (m[i + j] + m[np.abs(i - j)]) / 2
                if np.linalg.matrix_rank(gram, tol=1e-9 * max(m[0], 1e-300)) <= degree:
                    coefficients.append(None)
                    r2.append(None)
                    continue
                c = np.linalg.solve(gram, v)
                total = yy - v[0] ** 2 / m[0]
                coefficients.append(c)
                r2.append(1 - (yy - 2 * c @ v + c @ gram @ c) / total if total > 0 else None)
            yield pdf.drop(columns=["_m", "_v", "_yy", "_d"]).assign(coefficients=coefficients, r2=r2)

    keys = ", ".join(f"`{c}` {points.schema[c].dataType.simpleString()}" for c in by) + (", " if by else "")
    out = sums.mapInPandas(solve, f"{keys}_lo double, _hi double, n_points long, coefficients array<double>, r2 double")
    return out.select(*by, "n_points", F.col("_lo").alias("x_min"), F.col("_hi").alias("x_max"), "coefficients", "r2")


def value_at(x: Column, x_min: Column, x_max: Column, coefficients: Column) -> Column:
    """The polynomial's value (Clenshaw's recurrence, so x may lie outside the range)."""
    s = _scaled(x, x_min, x_max)
    start = F.struct(F.lit(0.0).alias("b"), F.lit(0.0).alias("a"))
    down = F.slice(F.reverse(coefficients), 1, F.size(coefficients) - 1)
    last = F.aggregate(down, start, lambda acc, c: F.struct((c + 2 * s * acc["b"] - acc["a"]).alias("b"), acc["b"].alias("a")))
    return F.element_at(coefficients, 1) + s * last["b"] - last["a"]
