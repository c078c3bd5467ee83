"""Boosting against a plain version of all rows in one array, folds against separate fits, exact strata, the stop."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ceasekit.operators import hist_boosting as H
from ceasekit.operators.ranking import auc
from ceasekit.operators.selection import ranked_keys
from ceasekit.plans import model as M
from ceasekit.plans import profiles as PR


@pytest.fixture(scope="module")
def gold(spark):
    x = [F.rand(i).alias(f"x{i}") for i in range(4)]
    df = spark.range(3000, numPartitions=3).select(F.col("id").cast("string").alias(M.ID), *x, F.rand(9).alias("noise"))
    label = (F.col("x0") + F.col("x1") * F.col("x2") + 0.4 * F.col("noise") > 0.95).cast("int")
    holes = F.when(F.col("x3") < 0.1, F.lit(None)).when(F.col("x3") < 0.2, F.lit(float("nan"))).otherwise(F.col("x3"))
    df = df.withColumn("x3", holes).withColumn("flag", (F.col("x0") > 0.8).cast("int")).withColumn("none", F.lit(None).cast("double"))
    return df.withColumn(M.LABEL, label).drop("noise")


PARAMS = M.BoostParams(max_trees=16, patience=3, learning_rate=0.3, max_depth=3)


@pytest.fixture(scope="module")
def trained(gold):
    return M.train_boosted_trees(gold, PARAMS)


def plain_trees(x, y, key, cuts, p, n):
    """Trees one node at a time over all rows; sums in the same whole multiples as the distributed sums."""
    bins = np.array([[0 if np.isnan(v) else 1 + sum(v >= c for c in cuts[f]) for f, v in enumerate(r)] for r in x])
    unit = 2.0 ** min(30, 60 - int(np.ceil(np.log2(len(y) * max(1, p.positive_weight)))))
    t = lambda g: np.sign(g) * max(abs(g) - p.l1, 0)
    score = lambda g, h: t(g) ** 2 / (h + 1)
    margin, trees = np.zeros(len(y)), []
    for k in range(n):
        g, h = H.gradients(margin, y, p, unit)
        drawn = H.sampled(key, p.seed, k, p.row_sample)
        columns = sorted(np.random.default_rng([p.seed, k]).choice(x.shape[1], max(1, int(p.column_sample * x.shape[1])), replace=False))
        tree = {}

        def build(node, rows, depth):
            use = rows[drawn[rows]]
            gs, hs = g[use].sum() / unit, h[use].sum() / unit
            best = (H.LEAST_GAIN, None)
            if depth < p.depth:
                for f in columns:
                    for missing in (0, 1):
                        for cut in range(1, len(cuts[f]) + 2):
                            left = (bins[use, f] <= cut) & (bins[use, f] > 0) | ((bins[use, f] == 0) & bool(missing))
                            a, b = g[use][left].sum() / unit, h[use][left].sum() / unit
                            if min(b, hs - b) >= p.min_child_weight and (gain := score(a, b) + score(gs - a, hs - b) - score(gs, hs)) > best[0]:
                                best = (gain, (int(f), cut, bool(missing)))
            if best[1] is None:
                tree[node] = -p.learning_rate * t(gs) / (hs + 1)
                margin[rows] += tree[node]
                return
            f, cut, missing = tree[node] = best[1]
            left = (bins[rows, f] <= cut) & (bins[rows, f] > 0) | ((bins[rows, f] == 0) & missing)
            build(2 * node + 1, rows[left], depth + 1)
            build(2 * node + 2, rows[~left], depth + 1)

        build(0, np.arange(len(y)), 0)
        trees.append(tree)
    return trees, margin


@pytest.mark.parametrize("partitions", [1, 7])
def test_trees_equal_plain_version(spark, gold, trained, partitions, monkeypatch):
    monkeypatch.setattr(H, "ROWS_PER_TASK", 200 if partitions > 1 else 10 ** 9)
    rows = M.training_rows(M.prepare(gold, PARAMS)[0], trained.features, 42, 1).where("part = 'fit'").limit(900).repartition(partitions)
    rows = H.written(rows, "test-rows")
    p = H.TreeParams(depth=3, learning_rate=0.3, positive_weight=2.5, min_child_weight=4.0, l1=0.5, seed=3)
    cuts = [c[::16] for c in trained.cuts]
    got = H.Training(rows, trained.features, 1, lambda part, fold: (part == "fit")[None, :], p, cuts=cuts)
    got.grow(2)
    got.grow(2)                                 # goes on from the written margins
    local = rows.select("key", "y", *trained.features).toPandas()
    want, margin = plain_trees(local[trained.features].to_numpy(float), local.y.to_numpy(float), local.key.to_numpy().astype(np.uint64), cuts, p, 4)
    for tree, plain in zip(got.trees[0], want, strict=True):
        for node, what in plain.items():
            if isinstance(what, tuple):
                assert (tree.feature[node], tree.cut[node], tree.missing_left[node]) == what
            else:
                assert tree.feature[node] == -1 and abs(tree.value[node] - what) < 1e-12
        assert tree.nodes == len(plain)
    after = {r.key: r.m for r in got.state.select("key", F.col("margins")[0].alias("m")).collect()}
    assert np.allclose([after[k] for k in local.key], margin, atol=1e-12)


def test_stop_keeps_best_prefix(trained):
    curve, best = trained.curve, trained.best
    assert len(trained.trees) == best
    monitor = [m for _, _, m in curve]
    assert M.best_prefix(monitor, 3)[0] == best and len(curve) in (best + 3, 16)
    assert best > 1 and max(monitor) > 0.8
    rows = M.learning_curve(trained).collect()
    assert [r.trees for r in rows] == list(range(1, len(curve) + 1))
    assert [r.trees for r in rows if r.is_best] == [best]


def test_best_prefix():
    assert M.best_prefix([0.5, 0.6, 0.6, 0.7, 0.7, 0.7], 2) == (4, True)
    assert M.best_prefix([0.5, 0.6, 0.6, 0.6, 0.9], 2) == (2, True)       # what follows the stop is not looked at
    assert M.best_prefix([0.5, 0.6], 2) == (2, False)
    assert M.best_prefix([None, None, None], 2) == (1, True)
    assert M.best_prefix([], 2) == (0, False)


def test_curve_is_exact(trained):
    exact = {r.part: r.auc for r in auc(M.score(trained), "score", M.LABEL, ["part"]).collect()}
    _, fit, monitor = trained.curve[trained.best - 1]
    assert abs(fit - exact["fit"]) < 1e-12 and abs(monitor - exact["monitor"]) < 1e-12


def test_folds_equal_separate_fits(spark, trained):
    """All folds grown in shared passes give the scores of one training per fold on its own rows."""
    together = M.fold_scores(trained, 4, folds=3).toPandas()
    assert len(together) == trained.data.where("part IN ('fit', 'monitor')").count()
    rows = H.written(M.training_rows(trained.data, trained.features, trained.params.seed, 3), "test-rows")
    p = M._tree_params(trained.params, trained.scale_pos_weight)
    for fold in range(3):
        alone = H.Training(rows, trained.features, 1, lambda part, f, fold=fold: (f != fold)[None, :], p, cuts=trained.cuts)
        alone.grow(4)
        want = alone.state.where(F.col("fold") == fold).select(F.col("margins")[0].alias("m")).toPandas().m
        assert sorted(together[together.fold == fold].score) == sorted(want)
    cv = M.cross_validate(trained, trained.best, folds=3).first()
    assert cv.folds == 3 and 0.7 < cv.cv_auc_mean <= 1 and cv.cv_auc_std >= 0


def test_not_worse_than_mllib(trained):
    """On the test part, against MLlib's boosted trees with the same number, depth and rate."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    filled = trained.data.fillna(-1.0, trained.features)
    filled = VectorAssembler(inputCols=trained.features, outputCol="v").transform(filled)
    model = GBTClassifier(featuresCol="v", labelCol=M.LABEL, maxIter=trained.best, stepSize=0.3, maxDepth=3, subsamplingRate=0.8, seed=1).fit(filled.where("part = 'fit'"))
    theirs = model.transform(filled.where("part = 'test'")).select(vector_to_array("probability")[1].alias("s"), M.LABEL)
    ours = auc(M.score(trained).where("part = 'test'"), "score", M.LABEL).first().auc
    assert ours >= auc(theirs, "s", M.LABEL).first().auc - 0.01 and ours > 0.85


def test_scores_and_importance(gold, trained):
    s = M.score(trained)
    assert s.count() == 3000 and s.where("score between 0 and 1").count() == 3000
    imp = {r.feature: r.importance for r in M.feature_importance(trained, top=None).collect()}
    assert set(imp) == {"x0", "x1", "x2", "x3", "flag", "none"} and imp["none"] == 0 and abs(sum(imp.values()) - 1) < 1e-9


def test_cuts(spark):
    df = spark.createDataFrame([(float(i % 3), float(i), 1.0 if i == 7 else 0.0, None if i % 2 else 5.0, float("nan")) for i in range(2000)],
                               "few double, many double, rare double, one double, gone double")
    few, many, rare, one, gone = H.quantile_cuts(df, df.columns)
    assert few.tolist() == [1.0, 2.0] and rare.tolist() == [1.0] and one.tolist() == [] and gone.tolist() == []
    assert 200 < len(many) <= 254 and np.abs(np.diff(many) - 2000 / 254).max() < 4
    x = np.array([[2.0, -5.0, 0.0, np.nan, 1.0], [0.5, 1e9, 1.0, 5.0, np.nan]])
    assert H.binned(x, [few, many, rare, one, gone]).tolist() == [[3, 1, 1, 0, 1], [1, len(many) + 1, 2, 1, 0]]


def test_exact_strata(spark):
    """Sizes per label within a row of the shares, whatever the partitioning; one label holds nearly all rows."""
    rows = spark.range(20_000).select(F.col("id").cast("string").alias(M.ID), F.when(F.col("id") % 97 == 0, 1).when(F.col("id") % 89 == 0, None).otherwise(0).alias(M.LABEL))
    got = M.early_stop_carve(M.stratified_split(rows)).toPandas()
    again = M.early_stop_carve(M.stratified_split(rows.repartition(9))).toPandas()
    key = lambda d: d.sort_values(M.ID).part.tolist()
    assert key(got) == key(again)
    for _, g in got.groupby(M.LABEL, dropna=False):
        n, part = len(g), g.part.value_counts()
        train = part["fit"] + part["monitor"]
        assert abs(train - 0.6 * n) <= 0.5 and abs(part["val"] - 0.2 * n) <= 1 and abs(part["test"] - 0.2 * n) <= 1
        assert abs(part["monitor"] - 0.1 * train) <= 0.5


def test_ranked_keys(spark):
    rng = np.random.default_rng(1)
    rows = [(g, int(k)) for g, n in ((None, 1), ("a", 7), ("b", 5000)) for k in rng.integers(0, 1 << 60, n)] + [("c", 5)] * 10
    df = spark.createDataFrame(rows, "g string, k long").repartition(5)
    got = {r.g: (r.none, r.half, r.all) for r in ranked_keys(df, ["g"], "k", {"none": 0.0, "half": 0.5, "all": 1.0}).collect()}
    for g in (None, "a", "b", "c"):
        keys = sorted(k for h, k in rows if h == g)
        assert got[g] == (-1, keys[int(0.5 * len(keys) + 0.5) - 1], keys[-1])


def test_rates_come_largest_first(spark):
    df = spark.createDataFrame([("a", 1)] * 2 + [("b", 0)] * 5 + [(None, 1)] * 3, "kind string, churned int")
    rows = PR.rate_by_category(df, "kind").collect()
    assert [r.kind for r in rows] == ["b", None, "a"]
    assert [round(r.pct_of_total) for r in rows] == [50, 30, 20]
    over = PR.rate_by_category(df, "kind", with_overall=True).collect()
    assert {r.overall_churn_rate for r in over} == {0.5}
