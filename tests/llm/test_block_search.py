"""Block matrix join against brute force: whole table, many blocks, copies, ties, odd vectors, bounds."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ceasekit.llm import block_search as bs

SF = "/root/testdata/sf0.001"
DOUBLES = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def brute(rows, k=5, every=50):
    """{(query id, vector): [(vec_id, score)]} by the contract, pair by pair."""
    kept = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for qi, qv in kept:
        if qi % every == 0:
            near = [(-sum(a * b for a, b in zip(qv, v, strict=True)) / (math.sqrt(sum(a * a for a in qv)) * math.sqrt(sum(b * b for b in v))), i)
                    for i, v in kept if len(v) == len(qv) and (i, v) != (qi, qv)]
            out[qi, qv] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def found(df):
    return {q: [(r.vec_id, r.score) for r in g.sort_values("rank").itertuples()] for q, g in df.toPandas().groupby("query_id")}


def same(got, want):
    assert len(got) == len(want)
    for (i, s), (j, t) in zip(got, want, strict=True):
        assert abs(s - t) < 1e-12 and (i == j or abs(s - t) < 1e-15)


def test_whole_table(spark):
    e = pd.read_parquet(f"{SF}/embeddings.parquet")
    x = np.stack(e.embedding).astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    got = found(bs.op12_nearest_neighbours(spark, SF))
    assert set(got) == set(e.vec_id[e.vec_id % 50 == 0])
    for q, near in got.items():
        s = x @ x[e.index[e.vec_id == q][0]]
        s[e.vec_id == q] = -2
        want = np.lexsort((e.vec_id, -s))[:5]
        assert [i for i, _ in near] == e.vec_id.iloc[want].tolist()
        assert np.allclose([v for _, v in near], s[want], atol=1e-12)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 8))
    out = [(i, (base[i % 40] + rng.normal(scale=0.01, size=8) * (i % 3)).tolist()) for i in range(600)]     # a third are exact copies
    out += [(600 + i, base[0].tolist()) for i in range(700)]                                                # one hot vector
    out += [(1300 + i, (base[i] * 2.0 ** (i % 7)).tolist()) for i in range(40)]                             # parallel vectors
    return out


@pytest.mark.parametrize("components", [(1 << 20, 1 << 20), (64, 800)])
def test_copies_ties_and_blocks(spark, rows, components):
    df = spark.createDataFrame(rows, DOUBLES).repartition(7)
    got = found(bs.nearest(df.where(F.col("vec_id") % 50 == 0), df, query_components=components[0], candidate_components=components[1]))
    want = {q: near for (q, _), near in brute(rows).items()}
    assert set(got) == set(want)
    for q, near in want.items():
        same(got[q], near)
        scores = [s for _, s in got[q]]
        assert scores == sorted(scores, reverse=True)
    assert [i for i, _ in got[650]] == [0, 120, 240, 360, 480]      # least ids among 700 copies


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (50, [1.0, 1.0, 1.0]), (100, None), (150, []), (200, [0.0, -0.0]),
            (250, [1.0, None]), (300, [nan, 1.0]), (350, [inf, 1.0]), (None, [1.0, 0.0]), (1, [1.0, -0.0]), (2, [-1.0, 0.0]),
            (400, [1e200, 1e200]), (3, [1e-200, 1e-200])]
    df = spark.createDataFrame(rows, DOUBLES).withColumn("score", F.lit("old")).withColumn("_key", F.lit(b"x"))
    pdf = bs.nearest(df.where(F.col("vec_id") % 50 == 0), df).toPandas()
    got = {q: sorted(zip(g["rank"], g.vec_id, g.score.round(12), strict=True)) for q, g in pdf.groupby("query_id")}
    assert set(got) == {0, 400}                                     # 50 is alone of its length
    r = round(math.sqrt(0.5), 12)
    assert got[400] == [(1, 3, 1.0), (2, 0, r), (3, 0, r), (4, 1, r), (5, 2, -r)]
    assert got[0] == sorted([(1, 1, 1.0), (2, 3, r), (3, 400, r), (4, 0, 0.0), (5, 2, -1.0),       # as [1, 0]
                             (1, 3, r), (2, 400, r), (3, 0, 0.0), (4, 1, 0.0), (5, 2, 0.0)])       # as [0, 1]
    nothing = df.where("false")
    assert bs.nearest(nothing, df).count() == 0 and bs.nearest(df, nothing).count() == 0
    with pytest.raises(TypeError):
        bs.nearest(df, df.withColumn("vec_id", F.col("vec_id").cast("string")))


def test_bounds_hold_and_prune(spark):
    rng = np.random.default_rng(2)
    for dims in (1, 64, 3000):                                      # 3000: several exact partial products
        a, b = rng.normal(size=(300, dims)) ** 3, rng.normal(size=(500, dims))
        q, c = bs.Coded(a), bs.Coded(b)
        near, error = bs.tile(q, slice(0, 300), c)
        exact = (a / np.linalg.norm(a, axis=1)[:, None]) @ (b / np.linalg.norm(b, axis=1)[:, None]).T
        assert (np.abs(near - exact) <= error).all()
        assert error.max() < 0.1                                    # also for components of very different size
    block = bs.Block([b"%d" % i for i in range(300)], rng.normal(size=(300, 64)), 6)
    pushed = []
    block.push = lambda i, j, s, ids, push=block.push: (pushed.append(len(i)), push(i, j, s, ids))
    for s in range(0, 20_000, 2048):
        block.meet([[s + i] for i in range(2048)], rng.normal(size=(2048, 64)))
    assert sum(pushed) < 0.02 * 300 * 20_480
