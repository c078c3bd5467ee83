"""Summary statistics, exact and approximate quantiles, cross-tabs."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ceasekit.operators.prefix import landed


def summary_stats(df: DataFrame, c: str, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Count, mean, sample stddev, min, quartiles, max of one column in one pass.

    ``exact`` uses :func:`exact_quantiles` (linear interpolation, bounded
    memory); otherwise ``percentile_approx`` (bounded sketch).
    """
    x = F.col(c).cast("double")
    if exact:
        e = exact_quantiles(df, c, (0.25, 0.5, 0.75)) or [None, None, None]
        q = [F.lit(v).cast("double") for v in e]
    else:
        q = [F.percentile_approx(x, p, accuracy).cast("double") for p in (0.25, 0.5, 0.75)]
    return df.agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("stddev"),
                  F.min(x).alias("min"), q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"),
                  F.max(x).alias("max"))


def crosstab_with_margins(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Counts of ``row`` x ``col`` with an ``All`` row and column (CUBE).

    ``values`` are the expected ``col`` values (fixed output columns).
    """
    cube = df.cube(row, col).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g"))
    lab_r = F.when(F.col("_g").bitwiseAND(2) > 0, F.lit("All")).otherwise(F.col(row).cast("string"))
    lab_c = F.when(F.col("_g").bitwiseAND(1) > 0, F.lit("All")).otherwise(F.col(col).cast("string"))
    long = cube.select(lab_r.alias(row), lab_c.alias("_c"), "n")
    cols = [str(v) for v in values] + ["All"]
    return long.groupBy(row).pivot("_c", cols).agg(F.first("n")) \
        .select(row, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("bigint").alias(f"{col}_{v}") for v in cols])


def sorted_string_agg(c, sep: str = ", ") -> Column:
    """Distinct values joined in sorted order (nulls skipped)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.array_sort(F.collect_set(col)), sep)


def pairwise_pearson(df: DataFrame, columns: Sequence[str], first_only: bool = False) -> DataFrame:
    """Pearson r of every column pair (i < j in ``columns`` order), with nulls
    and NaN skipped pairwise, in one scan. ``first_only`` keeps the pairs of the first
    column with each other column (a target correlation: k - 1 rows per task).

    Each task folds its Arrow batches into k x k co-moments with numpy. Values are
    shifted by a per-task reference (each column's first non-null value: well
    conditioned, and a constant column stays exactly constant), reduced per batch
    to per-pair counts, means, squared deviations and co-deviations, and merged
    into the task's running moments with Chan's pairwise update. Only k^2 numbers
    per task are shuffled. The tasks' moments are merged per pair around the
    smallest task reference (a window and an aggregate on the same (i, j)
    partitioning). Zero variance gives NaN, fewer than two pairs null.
    """
    import numpy as np
    import pandas as pd

    k = len(columns)
    vals = [F.col(f"`{c}`").cast("double") for c in columns]
    present = [v.isNotNull() & ~F.isnan(v) for v in vals]
    x = df.select(*[F.when(ok, v).otherwise(F.lit(0.0)).alias(f"x{i}") for i, (v, ok) in enumerate(zip(vals, present, strict=True))],
                  *[F.coalesce(ok, F.lit(False)).cast("double").alias(f"m{i}") for i, ok in enumerate(present)])
    if first_only:
        ii, jj = np.zeros(k - 1, dtype=int), np.arange(1, k)
    else:
        ii, jj = np.triu_indices(k, 1)

    def moments(xv, m, ref):
        y = (xv - ref) * m
        n = m.T @ m
        sa = y.T @ m                       # [a, b]: sum of shifted a over rows where a and b are present
        d = sa / np.where(n > 0, n, 1.0)
        return n, d, (y * y).T @ m - sa * d, y.T @ y - sa * d.T

    def merge(p, q):
        n1, mu1, q1, c1 = p
        n2, mu2, q2, c2 = q
        n = n1 + n2
        safe = np.where(n > 0, n, 1.0)
        w = n1 * n2 / safe
        delta = mu2 - mu1
        return n, mu1 + delta * n2 / safe, q1 + q2 + delta * delta * w, c1 + c2 + delta * delta.T * w

    def fold(batches):
        acc, ref, seen = None, np.zeros(k), np.zeros(k, dtype=bool)
        for pdf in batches:
            if not len(pdf):
                continue
            m = pdf.iloc[:, k:].to_numpy(dtype=float)
            xv = pdf.iloc[:, :k].to_numpy(dtype=float)
            new = ~seen & m.any(axis=0)    # a column's reference is fixed by its first non-null value
            if new.any():
                ref[new] = xv[m.argmax(axis=0), np.arange(k)][new]
                seen |= new
            b = moments(xv, m, ref)
            acc = b if acc is None else merge(acc, b)
        if acc is None:
            return
        n, mu, q, c = acc
        yield pd.DataFrame({"i": ii.astype("int32"), "j": jj.astype("int32"), "n": n[ii, jj],
                            "ra": ref[ii], "rb": ref[jj], "ma": mu[ii, jj], "mb": mu[jj, ii],
                            "qa": q[ii, jj], "qb": q[jj, ii], "c": c[ii, jj]})

    schema = "i int, j int, n double, ra double, rb double, ma double, mb double, qa double, qb double, c double"
    parts = x.mapInPandas(fold, schema)
    pair = Window.partitionBy("i", "j")
    has = F.col("n") > 0

    def dev(r, mu):                        # task mean minus the smallest task reference, without rounding it
        return F.coalesce(F.when(has, (F.col(r) - F.min(F.when(has, F.col(r))).over(pair)) + F.col(mu)), F.lit(0.0))

    t = parts.select("i", "j", "n", "qa", "qb", "c", dev("ra", "ma").alias("da"), dev("rb", "mb").alias("db"))
    s = t.groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("da")).alias("sa"), F.sum(F.col("n") * F.col("db")).alias("sb"),
        F.sum(F.col("qa") + F.col("n") * F.col("da") * F.col("da")).alias("qa"),
        F.sum(F.col("qb") + F.col("n") * F.col("db") * F.col("db")).alias("qb"),
        F.sum(F.col("c") + F.col("n") * F.col("da") * F.col("db")).alias("c"))
    va = F.col("qa") - F.col("sa") * F.col("sa") / F.col("n")
    vb = F.col("qb") - F.col("sb") * F.col("sb") / F.col("n")
    cov = F.col("c") - F.col("sa") * F.col("sb") / F.col("n")
    r = (F.when(F.col("n") < 2, F.lit(None).cast("double"))
         .when((va <= 0) | (vb <= 0), F.lit(float("nan")))
         .otherwise(F.least(F.greatest(cov / F.sqrt(va * vb), F.lit(-1.0)), F.lit(1.0))))
    names = F.array(*[F.lit(c) for c in columns])
    return s.select(F.element_at(names, F.col("i") + 1).alias("a"), F.element_at(names, F.col("j") + 1).alias("b"),
                    r.alias("r"))


SKETCH_K = 4096                 # of the KLL sketch
SKETCH_ERROR = 0.003            # rank error that a sketch of this size keeps far below (a miss is found and mended)
GATHER_ROWS = 1_000_000         # expected rows of one bracket that are gathered; larger ones are narrowed first


def exact_quantiles(df: DataFrame, c: str, probs: Sequence[float], k: int = SKETCH_K, gather_rows: int = GATHER_ROWS) -> list | None:
    """Exact quantiles (linear interpolation at rank p*(n-1)) with bounded memory; runs its jobs at
    once and returns the ``len(probs)`` numbers (like ``approxQuantile``), or None when the column
    has no values. One path at every size; nulls and NaN are skipped.

    1. One read: the row count and a mergeable KLL sketch, whose quantiles at the rank error on either
       side bracket every target.
    2. One read: rows outside the brackets are only counted, rows inside are reduced to (value, count)
       pairs (a value repeated a billion times is one row). The pairs are written, and a running count per
       bracket finds the order statistics.
    Brackets of more than ``gather_rows`` expected rows are narrowed first, by one more read each time that
    sketches every bracket by itself; a bracket that misses its target is taken again from the sketch, wider.
    """
    x = F.col(c).cast("double")
    data = df.select(x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    error = min(0.5, SKETCH_ERROR * SKETCH_K / k)

    sketched = F.kll_sketch_agg_double("_x", k).alias("_s")
    spark = df.sparkSession
    first = data.agg(F.count("_x").alias("n"), sketched).first()
    n = first.n
    if n == 0:
        return None
    ranks = [p * (n - 1) for p in probs]
    lower, upper = [math.floor(r) for r in ranks], [math.ceil(r) for r in ranks]

    def bracketed(sketch: bytes, e: float) -> list[tuple[float, float]]:
        """Per target the values that the sketch holds below and above its two ranks."""
        q = _sketch_quantiles(spark, [(sketch, [y for a, b in zip(lower, upper, strict=True) for y in (a / n - e, (b + 1) / n + e)])])[0]
        return [(q[2 * j] if lower[j] > 0 else -math.inf, q[2 * j + 1] if upper[j] < n - 1 else math.inf) for j in range(len(probs))]

    brackets = bracketed(first["_s"], error)
    expected = 2 * error * n + 2
    while True:
        cells = _merged(brackets)
        number = sum(((F.col("_x") >= F.lit(lo)).cast("int") + (F.col("_x") > F.lit(hi)).cast("int") for lo, hi in cells), F.lit(0))
        rows = data.select("_x", number.alias("_cell"))             # odd: inside a bracket
        inside = F.col("_cell") % 2 == 1
        if expected > gather_rows:
            seen = rows.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), sketched).collect()       # one per bracket and gap
            counts = {r["_cell"]: r.n for r in seen}
            narrowed = _narrowed(seen, counts, cells, lower, upper, error, spark)
            if narrowed is not None:
                shrunk = max((hi > lo) * 2 * error * counts.get(2 * i + 1, 0) for i, (lo, hi) in enumerate(cells)) + 2
                brackets, expected = narrowed, 0 if shrunk > expected / 2 else shrunk       # one value fills the bracket: gather
                continue
        else:
            pairs = rows.groupBy("_cell", F.when(inside, F.col("_x")).alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
            pairs = landed(pairs, "quantile-pairs")
            counts = {r["_cell"]: r.n for r in pairs.groupBy("_cell").agg(F.sum("_c").alias("n")).collect()}
            if _hit(counts, cells, brackets, lower, upper):
                break
        error = min(0.5, error * 4)                                 # a miss, about once in a hundred sketches
        brackets = bracketed(first["_s"], error) if error < 0.5 else [(-math.inf, math.inf)] * len(probs)
        expected = 0
    below = {cell: sum(v for d, v in counts.items() if d < cell) for cell in counts}
    run = Window.partitionBy("_cell").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = F.create_map(*[y for cell, v in below.items() for y in (F.lit(cell), F.lit(v).cast("long"))])
    cum = pairs.where(inside).withColumn("_cum", starts[F.col("_cell")] + F.sum("_c").over(run))
    wanted = sorted({*lower, *upper})
    got = cum.groupBy("_cell").agg(*[F.min(F.when(F.col("_cum") > r, F.col("_x"))).alias(f"r{i}") for i, r in enumerate(wanted)]).collect()
    value = {}
    for row in got:
        lo, hi = below[row["_cell"]], below[row["_cell"]] + counts[row["_cell"]]
        value |= {r: row[f"r{i}"] for i, r in enumerate(wanted) if lo <= r < hi}
    return [value[lower[j]] + (ranks[j] - lower[j]) * (value[upper[j]] - value[lower[j]]) for j in range(len(probs))]


def _merged(brackets: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Overlapping brackets as one, in order."""
    out: list = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _hit(counts: dict, cells: Sequence[tuple], brackets: Sequence[tuple], lower: Sequence[int], upper: Sequence[int]) -> bool:
    """Whether every target's two ranks lie in its bracket's cell."""
    for (lo, _), a, b in zip(brackets, lower, upper, strict=True):
        cell = 2 * next(i for i, (first, last) in enumerate(cells) if first <= lo <= last) + 1
        start = sum(v for d, v in counts.items() if d < cell)
        if not (start <= a and b < start + counts.get(cell, 0)):
            return False
    return True


def _narrowed(seen: Sequence, counts: dict, cells: Sequence[tuple], lower: Sequence[int], upper: Sequence[int], error: float, spark) -> list | None:
    """Brackets of the targets by the sketch of the bracket they lie in; None where one missed."""
    asked = []
    for j, (a, b) in enumerate(zip(lower, upper, strict=True)):
        for i, (lo, hi) in enumerate(cells):
            start, size = sum(v for d, v in counts.items() if d < 2 * i + 1), counts.get(2 * i + 1, 0)
            if start <= a and b < start + size:
                asked.append((2 * i + 1, j, (a - start) / size - error, (b - start + 1) / size + error))
                break
        else:
            return None
    sketch = {r["_cell"]: r["_s"] for r in seen}
    return [tuple(q) for q in _sketch_quantiles(spark, [(sketch[cell], [low, high]) for cell, _, low, high in asked])]


def _sketch_quantiles(spark, asked: Sequence[tuple[bytes, Sequence[float]]]) -> list[list[float]]:
    """Quantiles of each sketch at its shares."""
    kept = [(bytearray(s), [min(1.0, max(0.0, a)) for a in shares]) for s, shares in asked]
    return list(spark.range(1).select(*[F.kll_sketch_get_quantile_double(F.lit(s), F.array(*map(F.lit, shares))) for s, shares in kept]).first())
