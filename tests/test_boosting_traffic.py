"""What boosting writes and reduces: margins only, one half of each level, no ranking of the fit part before it is asked for."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ceasekit.operators import hist_boosting as H
from ceasekit.plans import model as M


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(700, numPartitions=3).select(F.xxhash64("id").alias("key"), F.when(F.col("id") % 5 == 0, "monitor").otherwise("fit").alias("part"), F.lit(0).alias("fold"),
                                                  ((F.col("id") * 7) % 11 > 6).cast("int").alias("y"), *[((F.col("id") * k) % 13).cast("double").alias(f"x{k}") for k in (3, 5, 7)])
    return H.written(df, "test-rows")


def members(part, fold):
    return (part == "fit")[None, :]


def test_right_children_are_the_parent_less_the_left_ones():
    rng = np.random.default_rng(5)
    t = H.Tree.empty(2)
    t.feature[0], t.feature[1] = 0, 1                        # the root and its left child are split, the right child is a leaf
    root, left = rng.integers(-99, 99, (1, 1, 4, 2)), rng.integers(-99, 99, (1, 1, 4, 2))
    one = H.with_siblings(left, root, [t.arrays()], 1)
    assert (one[:, 0] == left[:, 0]).all() and (one[:, 1] == root[:, 0] - left[:, 0]).all()
    below = np.concatenate([rng.integers(-99, 99, (1, 1, 4, 2)), np.zeros((1, 1, 4, 2), np.int64)], axis=1)
    two = H.with_siblings(below, one, [t.arrays()], 2)
    assert (two[:, 1] == one[:, 0] - below[:, 0]).all() and not two[:, 2:].any()


def test_written_table_holds_margins_only_and_reduced_sums_equal_those_of_one_task(rows, monkeypatch):
    p = H.TreeParams(depth=3, positive_weight=1.5, min_child_weight=2.0)
    monkeypatch.setattr(H, "ROWS_PER_TASK", 100)
    many = H.Training(rows, ["x3", "x5", "x7"], 1, members, p)
    many.grow(3)
    assert many.state.columns == ["key", "part", "fold", "y", "bins", "margins"]
    monkeypatch.setattr(H, "ROWS_PER_TASK", 10 ** 9)
    one = H.Training(rows, ["x3", "x5", "x7"], 1, members, p, cuts=many.cuts)
    one.grow(3)
    for a, b in zip(many.trees[0], one.trees[0], strict=True):
        assert a.nodes > 1 and all((x == y).all() for x, y in zip(a.arrays(), b.arrays(), strict=True))


def test_fit_part_is_ranked_only_for_the_curve(spark, monkeypatch):
    gold = spark.range(600).select(F.col("id").cast("string").alias(M.ID), (F.col("id") % 3 == 0).cast("int").alias(M.LABEL), ((F.col("id") * 7) % 10).cast("double").alias("x"))
    asked = []
    real = M.prefix_aucs
    monkeypatch.setattr(M, "prefix_aucs", lambda before, trees, part, *a: asked.append(part) or real(before, trees, part, *a))
    tm = M.train_boosted_trees(gold, M.BoostParams(max_trees=4, patience=2, max_depth=2, min_child_weight=1.0))
    assert set(asked) == {"monitor"}
    assert [m for _, _, m in tm.curve] == tm.monitor and all(f is not None for _, f, _ in tm.curve) and "fit" in asked
