"""Centroid clustering against plain Python integers: odd sizes, ties, flat geometry, bounds."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ceasekit.llm import centroids as ct

DOUBLES = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def brute(rows, k, rounds, dims, scale=256, seed=2):
    """[(id, cluster, distance, cluster inertia, inertia, digest)] by the contract in Python integers."""
    kept = [(i, [math.floor(x * scale) if math.isfinite(x * scale) else int(x) * scale for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in kept[:k]]
    for n in range(rounds + 1):
        best = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres)) for _, v in kept]
        if n < rounds:
            groups = defaultdict(list)
            for (_, v), (_, j) in zip(kept, best, strict=True):
                groups[j].append(v)
            centres = [[sum(col) // len(groups[j]) for col in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(centres)]
    long = lambda x: x if x < 1 << 63 else None
    sums = defaultdict(int)
    for d, j in best:
        sums[j] += d
    fits = {j: all(d < 1 << 63 for d, c in best if c == j) for j in sums}
    total = long(sum(sums.values())) if all(fits.values()) else None
    return sorted(((i, j, long(d), long(sums[j]) if fits[j] else None, total,
                    hashlib.sha256(",".join(map(str, centres[j])).encode()).hexdigest()) for (i, _), (d, j) in zip(kept, best, strict=True)), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, DOUBLES).repartition(5)
    return sorted((tuple(r) for r in ct.integer_kmeans(df, **kw).collect()), key=str)


@pytest.mark.parametrize("case", ["spread", "grid", "line", "copies"])
def test_against_brute_force(spark, case):
    rng = np.random.default_rng(4)
    x = {"spread": rng.normal(size=(300, 6)) * 10.0 ** rng.integers(-3, 3, size=(300, 1)),
         "grid": rng.integers(-2, 3, size=(300, 6)) / 256,                                  # many equal distances
         "line": np.outer(rng.integers(-9, 9, 300), np.ones(6)),                            # no altitude over one edge
         "copies": np.concatenate([np.repeat(rng.normal(size=(1, 6)), 200, axis=0), rng.normal(size=(100, 6))])}[case]
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    assert run(spark, rows, k=12, rounds=4, dims=6, pivots=5) == brute(rows, 12, 4, 6)


@pytest.mark.parametrize("size", [1e7, 1e13, 1e30, 1e307])
def test_components_of_any_size(spark, size):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=4) * (size if i % 7 == 0 else 1)).tolist()) for i in range(80)]
    assert run(spark, rows, k=6, rounds=3, dims=4, pivots=4) == brute(rows, 6, 3, 4)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (1, [0.25, -0.0]), (None, [1.0, 1.0]), (None, [1.0, 1.0]), (2, None), (3, []), (4, [1.0]),
            (5, [nan, 1.0]), (6, [1.0, -inf]), (7, [None, 1.0]), (8, [-0.001, 0.0]), (9, [1.0, 2.0, 3.0])]
    assert run(spark, rows, k=3, rounds=2, dims=2) == brute(rows, 3, 2, 2)
    assert len(run(spark, rows, k=40, rounds=2, dims=2)) == 6               # fewer vectors than clusters
    df = spark.createDataFrame(rows, DOUBLES).withColumn("cluster", F.lit("old")).withColumn("_vec", F.lit(0))
    assert ct.integer_kmeans(df, k=3, rounds=2, dims=2).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert ct.integer_kmeans(df.where("false")).count() == 0 and ct.integer_kmeans(df, dims=7).count() == 0


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(9)
    hubs = rng.normal(scale=200, size=(40, 64))
    x = np.floor(np.repeat(hubs, 50, axis=0) + rng.normal(scale=12, size=(2000, 64)))
    first = x[::50]
    base = ct.simplex(first, 12)
    assert len(base.pivots) == 12 and (np.abs(base.apex(base.pivots)[:, -1]) < 1e-2 * np.abs(first).max()).all()
    apex, centres = base.apex(x), base.apex(first)
    exact = ((x[:, None] - first[None]) ** 2).sum(axis=2)
    base2 = ((apex[:, None, :-1] - centres[None, :, :-1]) ** 2).sum(axis=2)
    gap, both = apex[:, -1:] - centres[None, :, -1], apex[:, -1:] + centres[None, :, -1]
    assert (base2 + gap ** 2 <= exact * (1 + 1e-9) + 1e-3).all() and (base2 + both ** 2 >= exact * (1 - 1e-9) - 1e-3).all()
    lower, least = ct.bounds(apex, centres)
    assert (lower <= exact).all() and (least >= exact.min(axis=1)).all()
    cluster, distance, pairs = ct.Centres(first.astype(int).tolist(), base).assign(x / 256, apex, 256)
    assert (cluster == exact.argmin(axis=1)).all() and distance == exact.min(axis=1).tolist()
    assert pairs < 0.05 * exact.size                                        # nearly all centroids are ruled out


def test_limbs():
    for total in (0, -1, 1 << 61, -(1 << 62), 1 << 62, -(1 << 200) + 12345, (1 << 1030) - 7):
        parts = list(ct.limbs(total))
        assert sum(p << (ct.LIMB * at) for at, p in parts) == total and all(-(1 << 63) <= p < 1 << 63 for _, p in parts)
