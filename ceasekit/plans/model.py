"""Model training and evaluation on gold, distributed end to end.

Splits are exact per label: customers are ordered by a seeded md5 of their id, and the rank in the label
decides. Training is second-order boosting on binned features with the study's parameters
(``operators.hist_boosting``): L1 on leaf weights, hessian weight of a child, rows and columns drawn per tree.
Early stopping is the study's: the exact AUC of every tree prefix on the monitor part, stopped after
``patience`` rounds without a better one, and the best prefix is kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ceasekit.config import MODEL_2_DROP, MODEL_2_DROP_PREFIX
from ceasekit.functions.keys import order_key, uniform
from ceasekit.operators.hist_boosting import BLOCK, Training, Tree, TreeParams, prefix_scores, sampler, scorer, values_of
from ceasekit.operators.ranking import auc
from ceasekit.operators.selection import ranked_keys, same

ID = "unique_customer_identifier"
LABEL = "churned"


@dataclass(frozen=True)
class BoostParams:
    """Training parameters of the study (per model). Fixed values."""
    max_trees: int = 1000
    learning_rate: float = 0.05
    max_depth: int = 5
    row_sample: float = 0.8
    column_sample: float = 0.8
    min_child_weight: float = 5.0
    l1: float = 0.1
    patience: int = 50
    seed: int = 42
    split_seed: int = 42
    carve_seed: int = 42


MODEL_1 = BoostParams()
MODEL_2 = BoostParams(seed=0, split_seed=0, carve_seed=0)
NON_FEATURES = (ID, "observation_date", "churn_label", LABEL)


def stratified_split(gold: DataFrame, seed: int = 42, key: str = ID, fractions=(0.6, 0.2, 0.2), label: str = LABEL) -> DataFrame:
    """M1: train / val / test with exact shares of every label: of a label's n rows, ordered by a seeded hash
    of the id, the first floor(0.6 n + 0.5) are train and those up to floor(0.8 n + 0.5) validation. Rows
    equal in the id go to the same part; a null label is a stratum of its own."""
    rows = gold.withColumn("_key", order_key(key, seed=seed))
    limits = ranked_keys(rows, [label], "_key", {"_train": fractions[0], "_val": fractions[0] + fractions[1]})
    split = F.when(F.col("_key") <= F.col("_train"), "train").when(F.col("_key") <= F.col("_val"), "val").otherwise("test")
    return rows.join(limits, same(rows, limits, [label]), "left").select(*[rows[f"`{c}`"] for c in gold.columns], split.alias("split"))


def early_stop_carve(split: DataFrame, seed: int = 42, key: str = ID, share: float = 0.1, label: str = LABEL) -> DataFrame:
    """M2: a ``share`` of train, exact per label, as the early-stopping monitor (by a second hash)."""
    rows = split.withColumn("_key", order_key(key, F.lit("monitor"), seed=seed))
    limits = ranked_keys(rows.where(F.col("split") == "train"), [label], "_key", {"_monitor": share})
    part = F.when(F.col("split") != "train", F.col("split")).when(F.col("_key") <= F.col("_monitor"), "monitor").otherwise("fit")
    return rows.join(limits, same(rows, limits, [label]), "left").select(*[rows[f"`{c}`"] for c in split.columns], part.alias("part"))


def split_report(parts: DataFrame, col: str = "part") -> DataFrame:
    """M3: rows and churn rate per part."""
    return parts.groupBy(col).agg(F.count(F.lit(1)).alias("rows"), F.avg(LABEL).cast("double").alias("churn_rate"))


def class_weight(parts: DataFrame) -> DataFrame:
    """M4: negatives / positives of the fit part (the positive-class weight)."""
    fit = parts.where(F.col("part") == "fit")
    return fit.agg(F.try_divide(F.count_if(F.col(LABEL) == 0).cast("double"),
                                F.count_if(F.col(LABEL) == 1)).alias("scale_pos_weight"))


def select_features(columns, reduced: bool = False) -> list[str]:
    """M5: every column except id and label; the reduced model also drops the ooc
    buckets (not the missing flag), the two dd columns and the contract statuses."""
    out = [c for c in columns if c not in NON_FEATURES]
    if reduced:
        out = [c for c in out if c not in MODEL_2_DROP and not c.startswith(MODEL_2_DROP_PREFIX)]
    return out


@dataclass
class TrainedModel:
    trees: list[Tree] = field(repr=False)
    cuts: list = field(repr=False)
    features: list
    params: BoostParams
    scale_pos_weight: float
    data: DataFrame = field(repr=False)
    monitor: list = field(repr=False)        # AUC on monitor of every prefix up to the stop
    blocks: list = field(repr=False)         # (training table before a block of trees, the trees of the block)
    best: int = 0

    @cached_property
    def curve(self) -> list[tuple[int, float | None, float | None]]:
        """(trees, AUC on fit, AUC on monitor) of every prefix up to the stop. Only the stop needs the monitor part
        for each block; the fit part, many times as large, is ranked when the curve is asked for."""
        fit = [a for before, trees in self.blocks for a in prefix_aucs(before, trees, "fit", len(self.features), self.params.max_depth)]
        return [(t + 1, fit[t], monitor) for t, monitor in enumerate(self.monitor)]


def prepare(gold: DataFrame, p: BoostParams, reduced: bool = False) -> tuple[DataFrame, list, float]:
    """Gold with its parts, the features, and the weight of a positive."""
    parts = early_stop_carve(stratified_split(gold, p.split_seed), p.carve_seed)
    return parts, select_features(gold.columns, reduced), float(class_weight(parts).first()[0] or 1.0)


def training_rows(parts: DataFrame, features: Sequence[str], seed: int, folds: int) -> DataFrame:
    """Fit and monitor rows with the hash of the id, their fold (not stratified) and the label."""
    fold = (uniform(ID, F.lit("fold"), seed=seed) * folds).cast("int")
    return parts.where(F.col("part").isin("fit", "monitor") & F.col(LABEL).isNotNull()).select(
        F.xxhash64(ID).alias("key"), "part", fold.alias("fold"), F.col(LABEL).cast("int").alias("y"), *[F.col(f"`{c}`") for c in features])


def _tree_params(p: BoostParams, spw: float) -> TreeParams:
    return TreeParams(p.max_depth, p.learning_rate, p.row_sample, p.column_sample, p.min_child_weight, p.l1, spw, p.seed)


def train_boosted_trees(gold: DataFrame, p: BoostParams = MODEL_1, reduced: bool = False) -> TrainedModel:
    """M6: boosted trees on the fit part, stopped by the AUC on the monitor part. Trees grow in blocks that
    go on from the written margins; those of the last block beyond the stop are dropped."""
    parts, features, spw = prepare(gold, p, reduced)
    rows = training_rows(parts, features, p.seed, 1)

    def fit_rows(part: np.ndarray, fold: np.ndarray) -> np.ndarray:
        return (part == "fit")[None, :]

    training = Training(rows, features, 1, fit_rows, _tree_params(p, spw), cuts_from=rows.where(F.col("part") == "fit"))
    monitor: list = []
    best, stopped = 0, False
    while not stopped and len(monitor) < p.max_trees:
        left = min((best or 1) + p.patience, p.max_trees) - len(monitor)       # before that no stop is possible
        training.grow(-(-left // -(-left // BLOCK)))
        before, new = training.earlier[-1]
        monitor += prefix_aucs(before, new[0], "monitor", len(features), p.max_depth)
        best, stopped = best_prefix(monitor, p.patience)
    if stopped:
        monitor = monitor[:best + p.patience]
    blocks = [(before, new[0]) for before, new in training.earlier]
    return TrainedModel(training.trees[0][:best], training.cuts, features, p, spw, parts, monitor, blocks, best)


def prefix_aucs(before: DataFrame, trees: Sequence[Tree], part: str, width: int, depth: int) -> list[float | None]:
    """AUC on one part of every prefix that ends in a block of trees, from the table before it: exact, in one pass."""
    rows = prefix_scores(before.where(F.col("part") == part), trees, width, depth)
    found = {r["_at"]: r.auc for r in auc(rows, "score", "y", ["_at"]).collect()}      # one row per tree
    return [found.get(t) for t in range(len(trees))]


def best_prefix(curve: Sequence[float | None], patience: int) -> tuple[int, bool]:
    """(prefix with the first best AUC, whether ``patience`` rounds without a better one followed it).
    Rounds after that point are not looked at. A part with one class only has no AUC and counts as 0.5."""
    best, best_auc = 0, -1.0
    for trees, value in enumerate((0.5 if a is None else a for a in curve), 1):
        if value > best_auc:
            best, best_auc = trees, value
        elif trees - best >= patience:
            return best, True
    return best, False


def score(tm: TrainedModel, df: DataFrame | None = None) -> DataFrame:
    """Churn probability per customer."""
    d = tm.data if df is None else df
    kinds = {c: d.schema[c].dataType.simpleString() for c in (ID, LABEL, "part")}
    out = d.select(*kinds, values_of(d, tm.features)).mapInArrow(
        scorer(tm.trees, tm.cuts, len(tm.features), tm.params.max_depth), ", ".join(f"`{c}` {k}" for c, k in kinds.items()) + ", _margin double")
    p = 1 / (1 + F.exp(-F.col("_margin")))
    return out.select(*kinds, p.alias("score"), (p > 0.5).cast("int").alias("predicted"))


def tree_margins(tm: TrainedModel, df: DataFrame, tree: int = 0) -> DataFrame:
    """(id, label, margin that one tree gives, whether the row was drawn for it)."""
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in (ID, LABEL))
    rows = df.select(ID, LABEL, F.xxhash64(ID).alias("_key"), values_of(df, tm.features)).mapInArrow(
        scorer(tm.trees[tree:tree + 1], tm.cuts, len(tm.features), tm.params.max_depth), f"{kinds}, _key long, _margin double")
    return rows.mapInArrow(sampler(tm.params.seed, tree, tm.params.row_sample), f"{kinds}, _margin double, _sampled boolean")


def learning_curve(tm: TrainedModel) -> DataFrame:
    """M7: AUC of every tree prefix up to the stop on the fit and monitor parts; the best prefix marked."""
    rows = [(trees, fit, monitor, int(trees == tm.best)) for trees, fit, monitor in tm.curve]
    return tm.data.sparkSession.createDataFrame(rows, "trees int, fit_auc double, monitor_auc double, is_best int")


def fold_scores(tm: TrainedModel, trees: int, folds: int = 5) -> DataFrame:
    """(fold, y, score) of every training row (fit and monitor), scored by the model of ``trees`` trees that
    was grown without the row's fold. The models of all folds grow in the same passes over one table."""
    rows = training_rows(tm.data, tm.features, tm.params.seed, folds)

    def others(part: np.ndarray, fold: np.ndarray) -> np.ndarray:
        return np.arange(folds)[:, None] != fold[None, :]

    training = Training(rows, tm.features, folds, others, _tree_params(tm.params, tm.scale_pos_weight), cuts=tm.cuts)
    for start in range(0, trees, BLOCK):
        training.grow(min(BLOCK, trees - start))
    return training.state.select("fold", "y", F.get("margins", F.col("fold")).alias("score"))


def fold_aucs(tm: TrainedModel, trees: int, folds: int = 5) -> DataFrame:
    """(fold, auc, positives, negatives) on each fold held out."""
    return auc(fold_scores(tm, max(trees, 1), folds), "score", "y", ["fold"])


def cross_validate(tm: TrainedModel, trees: int, folds: int = 5) -> DataFrame:
    """M8: k folds (hash of id, not stratified) over train including the monitor, with ``trees`` trees (the
    best prefix, 1-based); mean and population std of the fold AUCs."""
    return summarised_folds(fold_aucs(tm, trees, folds), trees)


def summarised_folds(aucs: DataFrame, trees: int) -> DataFrame:
    return aucs.agg(F.count(F.lit(1)).cast("int").alias("folds"), F.lit(trees).alias("trees"), F.avg("auc").alias("cv_auc_mean"),
                    F.stddev_pop("auc").alias("cv_auc_std"))


def classification_report(scored: DataFrame, by=("part",), label: str = LABEL, pred: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and
    weighted averages, per group; from one confusion-count aggregate."""
    by = list(by)
    cm = scored.groupBy(*by).agg(
        *[F.count_if((F.col(label) == a) & (F.col(pred) == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    rows = []
    for k in (0, 1):
        o = 1 - k
        tp, fp, fn = F.col(f"c{k}{k}"), F.col(f"c{o}{k}"), F.col(f"c{k}{o}")
        prec = F.coalesce(F.try_divide(tp.cast("double"), tp + fp), F.lit(0.0))
        rec = F.coalesce(F.try_divide(tp.cast("double"), tp + fn), F.lit(0.0))
        f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
        rows.append((str(k), prec, rec, f1, (tp + fn).cast("double")))
    total = sum((F.col(f"c{a}{b}") for a in (0, 1) for b in (0, 1)), F.lit(0)).cast("double")
    acc = F.try_divide((F.col("c00") + F.col("c11")).cast("double"), total)
    macro = [(rows[0][i] + rows[1][i]) / 2 for i in (1, 2, 3)]
    wavg = [F.try_divide(rows[0][i] * rows[0][4] + rows[1][i] * rows[1][4], total) for i in (1, 2, 3)]
    structs = [F.struct(F.lit(n).alias("metric"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        s.alias("support")) for n, p, r, f, s in rows]
    structs.append(F.struct(F.lit("accuracy").alias("metric"), F.lit(None).cast("double").alias("precision"),
                            F.lit(None).cast("double").alias("recall"), acc.alias("f1"), total.alias("support")))
    structs.append(F.struct(F.lit("macro avg").alias("metric"), *[m.alias(n) for m, n in
                                                                   zip(macro, ("precision", "recall", "f1"))],
                            total.alias("support")))
    structs.append(F.struct(F.lit("weighted avg").alias("metric"), *[m.alias(n) for m, n in
                                                                      zip(wavg, ("precision", "recall", "f1"))],
                            total.alias("support")))
    return cm.select(*by, F.inline(F.array(*structs)))


def feature_importance(tm: TrainedModel, top: int | None = 20) -> DataFrame:
    """Mean gain of a feature's splits, as a share of the sum over features, the ``top`` largest (a top-k
    report; None: all)."""
    gain, splits = np.zeros(len(tm.features)), np.zeros(len(tm.features))
    for t in tm.trees:
        used = t.feature >= 0
        np.add.at(gain, t.feature[used], t.gain[used])
        np.add.at(splits, t.feature[used], 1)
    mean = gain / np.maximum(splits, 1)
    share = mean / (mean.sum() or 1.0)
    rows = sorted(zip(tm.features, share.tolist(), strict=True), key=lambda r: -r[1])[:top]
    return tm.data.sparkSession.createDataFrame(rows, "feature string, importance double")


def run_summary(spark: SparkSession, metrics: dict) -> DataFrame:
    """One row per metric (name, value as text)."""
    return spark.createDataFrame([(k, str(v)) for k, v in metrics.items()], "metric string, value string")
