"""Parity of the custom aggregates with plain single-machine definitions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ceasekit.operators.ranking import auc
from ceasekit.plans import profiles as PR


def test_qcut_matches_pandas(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([np.zeros(400), rng.exponential(5, 600).round(1)])
    pdf = pd.DataFrame({"id": range(len(vals)), "total": vals})
    want = pd.qcut(pdf["total"], q=10, labels=False, duplicates="drop")
    got = PR.qcut(spark.createDataFrame(pdf), "total", 10, "b").toPandas().sort_values("id")["b"].to_numpy()
    assert (got == want.to_numpy()).all()


def test_exact_edges_match_numpy(spark):
    rng = np.random.default_rng(4)
    vals = rng.integers(0, 50, 1001).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    probs = [0.1 * i for i in range(1, 10)]
    got = df.select(PR.quantile_edges(df, "x", probs, exact=True).alias("e")).first().e
    assert np.allclose(got, np.percentile(vals, [p * 100 for p in probs]))


def test_exact_quantiles_bracket_path(spark):
    from ceasekit.operators.stats import exact_quantiles
    rng = np.random.default_rng(8)
    vals = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25)])
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    probs = [0.0, 0.05, 0.3, 0.5, 0.77, 1.0]
    got = exact_quantiles(df, "x", probs, k=64)
    assert np.allclose(got, np.percentile(vals, [p * 100 for p in probs]))


def test_min_size_buckets_match_loop(spark):
    rng = np.random.default_rng(5)
    days = rng.integers(-170, -79, 3000)
    churned = rng.integers(0, 2, 3000)
    pdf = pd.DataFrame({"ooc_days": days.astype(float), "churned": churned})
    got = PR.min_size_buckets(spark.createDataFrame(pdf), min_size=200).orderBy("bucket").collect()
    daily = pdf.groupby("ooc_days").agg(n=("churned", "size"), s=("churned", "sum")).sort_index()
    want, n, s, dd = [], 0, 0, []
    for day, row in daily.iterrows():
        dd.append(day); n += row.n; s += row.s
        if n >= 200:
            want.append((np.mean(dd), s / n, n)); n, s, dd = 0, 0, []
    if n:
        want.append((np.mean(dd), s / n, n))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert abs(g.ooc_mid - w[0]) < 1e-9 and abs(g.churn_rate - w[1]) < 1e-12 and g.n == w[2]


def test_auc_with_ties_matches_rank_formula(spark):
    rng = np.random.default_rng(6)
    n = 2000
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n), "s": rng.integers(0, 40, n) / 40.0, "y": rng.integers(0, 2, n)})
    got = {r.g: r.auc for r in auc(spark.createDataFrame(pdf), "s", "y", ["g"], partitions=5).collect()}
    for g, part in pdf.groupby("g"):
        r = part["s"].rank()
        p, q = part["y"].sum(), (1 - part["y"]).sum()
        want = (r[part["y"] == 1].sum() - p * (p + 1) / 2) / (p * q)
        assert abs(got[g] - want) < 1e-12


def test_auc_hot_tied_score_no_groups(spark):
    # a third of the rows share one score; the rest are continuous, spread over many partitions
    rng = np.random.default_rng(8)
    n = 3000
    s = np.where(rng.random(n) < 0.34, 0.5, rng.random(n))
    pdf = pd.DataFrame({"s": s, "y": rng.integers(0, 2, n)})
    got = auc(spark.createDataFrame(pdf), "s", "y", partitions=7).first()
    r = pdf["s"].rank()
    p, q = pdf["y"].sum(), (1 - pdf["y"]).sum()
    want = (r[pdf["y"] == 1].sum() - p * (p + 1) / 2) / (p * q)
    assert abs(got.auc - want) < 1e-12 and got.positives == p and got.negatives == q


def test_poly_fit_matches_numpy(spark):
    from ceasekit.plans.fits import poly_fit
    rng = np.random.default_rng(7)
    x = np.linspace(-150, 170, 60)
    y = 0.5 + 0.001 * x - 2e-6 * x ** 2 + rng.normal(0, 0.01, x.size)
    w = rng.integers(1, 50, x.size).astype(float)
    pts = spark.createDataFrame(pd.DataFrame({"x": x, "y": y, "w": w}))
    f = poly_fit(pts, "x", "y", 3, weight="w")
    pred = f.predict(pts).toPandas().sort_values("x")["prediction"].to_numpy()
    coef = np.polyfit(x, y, 3, w=np.sqrt(w))
    assert np.allclose(pred, np.polyval(coef, x), atol=1e-8)


def test_quantiles_one_path_at_every_size(spark):
    from ceasekit.operators.stats import exact_quantiles
    rng = np.random.default_rng(11)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    for n in (1, 2, 7, 4000):
        v = np.round(rng.exponential(10, n), 2)
        got = exact_quantiles(spark.createDataFrame(pd.DataFrame({"x": v})), "x", probs, k=64)
        assert np.allclose(got, np.quantile(v, probs), rtol=0, atol=1e-12)
    assert exact_quantiles(spark.createDataFrame([(None,), (float("nan"),)], "x double"), "x", probs) is None


def _counted(spark, df):
    """``df`` through a task that counts the rows it hands on."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    return df.mapInArrow(run, df.schema), seen


@pytest.mark.parametrize("gather", [10 ** 6, 40])
def test_quantiles_read_the_input_twice_or_narrow_first(spark, gather):
    """Two reads while the brackets are small; more, each narrowing every bracket, where they are not."""
    from ceasekit.operators.stats import exact_quantiles
    rng = np.random.default_rng(13)
    probs = [0.01, 0.3, 0.31, 0.5, 0.9]
    v = np.concatenate([rng.normal(size=20_000), np.full(9_000, 0.5), rng.integers(0, 3, 1_000) * 1.0])
    df, seen = _counted(spark, spark.createDataFrame(pd.DataFrame({"x": v})).repartition(6))
    got = exact_quantiles(df, "x", probs, k=256, gather_rows=gather)
    assert np.allclose(got, np.quantile(v, probs), rtol=0, atol=1e-12)
    assert seen.value == 2 * len(v) if gather == 10 ** 6 else 2 * len(v) < seen.value <= 5 * len(v)


def test_quantiles_mend_a_missed_bracket(spark, monkeypatch):
    from ceasekit.operators import stats
    monkeypatch.setattr(stats, "SKETCH_ERROR", 1e-7)
    v = np.random.default_rng(3).normal(size=20_000)
    got = stats.exact_quantiles(spark.createDataFrame(pd.DataFrame({"x": v})), "x", [0.2, 0.7], k=16)
    assert np.allclose(got, np.quantile(v, [0.2, 0.7]), rtol=0, atol=1e-12)


def test_prefix_scan(spark):
    from ceasekit.operators.prefix import prefix_scan
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"k": rng.permutation(5000), "v": rng.integers(-9, 9, 5000)})
    df = spark.createDataFrame(pdf).withColumn("v", F.when(F.col("v") != 0, F.col("v")))
    for order, asc in ((["k"], True), ([F.col("k").desc()], False)):
        got = prefix_scan(df, order, {"total": ("sum", F.col("v")), "least": ("min", F.col("v")), "most": ("max", F.col("v"))}, partitions=7)
        got = got.toPandas().sort_values("k", ascending=asc)
        v = pdf.sort_values("k", ascending=asc).v
        assert got.total.fillna(0).tolist() == v.cumsum().tolist()
        known = v.where(v != 0)
        assert got.least.tolist()[9:] == known.cummin().ffill().tolist()[9:] and got.most.tolist()[9:] == known.cummax().ffill().tolist()[9:]
    assert prefix_scan(df.where("k < 0"), ["k"], {"total": ("sum", F.col("v"))}).count() == 0


def test_reached(spark):
    from ceasekit.operators.prefix import reached
    links = spark.range(1, 1000).select(F.col("id").alias("at"), (F.col("id") + F.when(F.col("id") % 5 == 0, 7).otherwise(3)).alias("next"))
    want, at = set(), 1
    while at < 1007 and at not in want:
        want.add(at)
        if at >= 1000:
            break
        at += 7 if at % 5 == 0 else 3
    assert {r["at"] for r in reached(links, 1).collect()} == want
    assert [r["at"] for r in reached(links.where("at < 0"), 4).collect()] == [4]


def test_min_size_buckets_of_many_values(spark):
    """A hundred thousand distinct values, buckets of uneven sizes, against the walk in plain Python."""
    rng = np.random.default_rng(6)
    n = 100_000
    v, c = np.arange(n) / 8 - 3000, rng.integers(1, 40, n)
    c[500] = 5000
    per = spark.createDataFrame(pd.DataFrame({"ooc_days": v, "c": c}))
    rows = per.select("ooc_days", F.explode(F.sequence(F.lit(1), F.col("c"))).alias("churned")).withColumn("churned", (F.col("churned") % 3 == 0).cast("int"))
    got = PR.min_size_buckets(rows, lo=-1e9, hi=1e9, min_size=300).orderBy("bucket").toPandas()
    want, size, first = [], 0, 0
    for i in range(n):
        size += c[i]
        if size >= 300 or i == n - 1:
            want.append((size, v[first:i + 1].mean()))
            size, first = 0, i + 1
    assert got.bucket.tolist() == list(range(1, len(want) + 1)) and got.n.tolist() == [w[0] for w in want]
    assert np.allclose(got.ooc_mid, [w[1] for w in want])


def test_pearson_skips_nan_at_any_partitioning(spark):
    from ceasekit.operators.stats import pairwise_pearson
    rng = np.random.default_rng(12)
    pdf = pd.DataFrame({"a": rng.normal(size=2000)})
    pdf["b"] = pdf["a"] + rng.normal(size=2000)
    pdf.loc[1234, "a"] = np.nan
    rows = [(None if i == 77 else float(a), float(b)) for i, (a, b) in enumerate(pdf.itertuples(index=False))]
    want = pdf.drop(index=77)["a"].corr(pdf.drop(index=77)["b"])
    for parts in (1, 2, 8):
        got = pairwise_pearson(spark.createDataFrame(rows, "a double, b double").repartition(parts), ["a", "b"]).first().r
        assert abs(got - want) < 1e-9


def test_usage_after_ignores_null_ids(spark):
    import datetime as dt
    from ceasekit.plans.quality import usage_after
    d = dt.date
    usage = spark.createDataFrame([(None, d(2024, 2, 1)), ("c1", d(2024, 2, 1))], "id string, day date")
    cease = spark.createDataFrame([(None, d(2024, 1, 1)), ("c1", d(2024, 1, 1))], "id string, placed date")
    r = usage_after(usage, cease, "id", "day", "placed").first()
    assert (r.customers, r.records) == (1, 1)


def test_poly_summary_needs_more_points_than_the_degree(spark):
    from ceasekit.plans.fits import fit_summary
    r = fit_summary(spark.createDataFrame([(1.0, 2.0), (2.0, 3.0)], "x double, y double"), "x", "y", 6).first()
    assert r.n_points == 2 and r.r2 is None
