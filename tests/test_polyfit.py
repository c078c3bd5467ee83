"""Polynomials of many groups from moments against numpy, audits taken during a write, sketches, hand-off."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ceasekit.operators.polyfit import fit_groups, value_at
from ceasekit.plans import quality as Q
from ceasekit.sources import io as IO


def test_group_fits_equal_numpy(spark):
    rng = np.random.default_rng(1)
    frames = []
    for i, g in enumerate(["a", "b", None]):
        x = rng.uniform(-150, 170, 400 + 100 * i)
        frames.append(pd.DataFrame({"g": g, "x": x, "y": np.sin(x / 40) + rng.normal(scale=0.1, size=len(x)), "w": rng.integers(1, 9, len(x)).astype(float)}))
    frames.append(pd.DataFrame({"g": "few", "x": [1.0, 2.0, 2.0], "y": [1.0, 2.0, 3.0], "w": 1.0}))
    frames.append(pd.DataFrame({"g": "a", "x": [np.nan, 3.0], "y": [1.0, np.nan], "w": 1.0}))
    pdf = pd.concat(frames)
    df = spark.createDataFrame([tuple(None if isinstance(v, float) and np.isnan(v) and k % 2 else v for v in r) for k, r in enumerate(pdf.itertuples(index=False))],
                               "g string, x double, y double, w double").repartition(5)
    for weight in (None, "w"):
        fits = fit_groups(df, ["g"], "x", "y", 6, weight)
        got = {r.g: r for r in fits.collect()}
        assert got["few"].coefficients is None and got["few"].n_points == 3
        for g in ("a", "b", None):
            p = pdf[pdf.g.isna() if g is None else pdf.g == g].dropna(subset=["x", "y"])
            want = np.polynomial.Chebyshev.fit(p.x, p.y, 6, w=np.sqrt(p.w) if weight else None)
            assert np.allclose(got[g].coefficients, want.coef, atol=1e-8) and got[g].n_points == len(p)
            w = p.w if weight else np.ones(len(p))
            mean = (w * p.y).sum() / w.sum()
            assert abs(got[g].r2 - (1 - (w * (p.y - want(p.x)) ** 2).sum() / (w * (p.y - mean) ** 2).sum())) < 1e-9
            at = spark.createDataFrame([(v, *got[g][2:5]) for v in (-160.0, 0.0, 33.3, 180.0)], "x double, lo double, hi double, c array<double>")
            assert np.allclose([r[0] for r in at.select(value_at(F.col("x"), F.col("lo"), F.col("hi"), F.col("c"))).collect()], want(np.array([-160.0, 0.0, 33.3, 180.0])), atol=1e-8)
    assert fit_groups(df.where("x > 1e9"), ["g"], "x", "y", 2).count() == 0
    flat = fit_groups(spark.createDataFrame([(2.0, 5.0), (2.0, 7.0)], "x double, y double"), [], "x", "y", 0).first()
    assert flat.coefficients == [6.0] and flat.n_points == 2


def test_audit_counts_while_it_writes(spark):
    audit = Q.StageAudit(most=F.max("id").cast("double"))
    first = audit.watch("all", spark.range(1000))
    kept = audit.watch("kept", first.where("id % 7 = 0"))
    path = IO.scratch_path(spark, "audited")
    kept.write.parquet(path)
    assert {r.stage: (r.n, r.most) for r in audit.report(spark).collect()} == {"all": (1000, 999.0), "kept": (143, 994.0)}
    assert spark.read.parquet(path).count() == 143


def test_audited_plan_reads_as_often_as_the_plain_one(spark):
    """Watching adds no scan and no exchange to the plan of the observation set."""
    from ceasekit.catalog.study import study
    from ceasekit.plans import observation as OB
    s = study(spark, "/root/testdata/sf0.001")
    plain = OB.observation_set(s.info, s.cease, s.cfg)._jdf.queryExecution().executedPlan().toString()
    watched = OB.observation_set(s.info, s.cease, s.cfg, Q.StageAudit().watch)._jdf.queryExecution().executedPlan().toString()
    for node in ("FileScan", "Exchange"):
        assert watched.count(node) <= plain.count(node)


def test_sketched_movement(spark):
    rows = spark.range(60_000).select(F.col("id").alias("k"), F.lit(1).alias("p")).unionByName(
        spark.range(20_000, 90_000).select(F.col("id").alias("k"), F.lit(2).alias("p"))).unionByName(spark.range(5).select(F.col("id").alias("k"), F.lit(0).alias("p")))
    sketches = Q.period_sketches(rows.unionByName(rows), "k", "p")
    got = Q.estimated_movement(sketches.where("p > 0"), "p").first()
    bound = 3 / np.sqrt(2 ** 14 - 1) * 90_000
    for name, want in (("only_in_first", 20_000), ("only_in_last", 30_000), ("in_both", 40_000), ("in_either", 90_000)):
        assert abs(got[name] - want) <= bound
    small = Q.estimated_movement(Q.period_sketches(rows.where("k < 100 AND p < 2"), "k", "p"), "p").first()
    assert (small.only_in_first, small.only_in_last, small.in_both) == (0, 95, 5)


def test_hand_off_refuses_instead_of_cutting(spark):
    assert IO.hand_off(spark.range(10), 10)["id"].tolist() == list(range(10))
    with pytest.raises(ValueError):
        IO.hand_off(spark.range(11), 10)
