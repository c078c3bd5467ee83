"""Registered queries: splits, metrics and model training."""

from __future__ import annotations

from pyspark.sql import functions as F

from ceasekit.catalog import QUERIES, query
from ceasekit.catalog.study import study
from ceasekit.functions.keys import uniform
from ceasekit.oracle_sql import register
from ceasekit.operators.ranking import auc
from ceasekit.plans import model as M
from ceasekit.sources.io import scratch_path

ID, LABEL = M.ID, M.LABEL


def _u_sql(*parts: str) -> str:
    return (f"CAST(CAST(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8)) AS BIGINT) AS DOUBLE)"
            f" / 4294967296.0")


def _key_sql(*parts: str) -> str:
    return f"CAST(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 15)) AS BIGINT)"


register("gold_split", f"""
SELECT {ID}, churned, CASE WHEN r <= floor(0.6 * n + 0.5) THEN 'train' WHEN r <= floor(0.8 * n + 0.5) THEN 'val' ELSE 'test' END AS split
FROM (SELECT {ID}, churned, row_number() OVER (PARTITION BY churned ORDER BY {_key_sql(ID, "'42'")}) AS r,
             count(*) OVER (PARTITION BY churned) AS n FROM gold)""")
register("gold_parts", f"""
SELECT {ID}, churned, split, CASE WHEN split <> 'train' THEN split WHEN r <= floor(0.1 * n + 0.5) THEN 'monitor' ELSE 'fit' END AS part
FROM (SELECT *, row_number() OVER (PARTITION BY churned, split ORDER BY {_key_sql(ID, "'monitor'", "'42'")}) AS r,
             count(*) OVER (PARTITION BY churned, split) AS n FROM gold_split)""")
register("scored_fixture", f"""
SELECT {ID}, churned, split, part, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted
FROM (SELECT p.*, {_u_sql('r.' + ID, 'CAST(r.behav_win AS VARCHAR)', "'42'")} AS score FROM raw_info r JOIN gold_parts p ON p.{ID} = r.{ID})""")


def _parts(s):
    return M.early_stop_carve(M.stratified_split(s.gold.select(ID, "churned"), 42), 42)


def scored_fixture(s):
    """A fixed score per customer (md5 of id|month|seed), for metric checks."""
    r = s.raw_info.select(ID, "churned", "behav_win")
    sc = M.early_stop_carve(M.stratified_split(r, 42), 42)
    u = uniform(ID, "behav_win", seed=42)
    return sc.select(ID, "churned", "split", "part", u.alias("score"),
                     F.when(u >= 0.5, 1).otherwise(0).alias("predicted"))


@query("m1_stratified_split", "SELECT * FROM gold_split")
def m1(spark, d):
    return M.stratified_split(study(spark, d).gold.select(ID, "churned"), 42)


@query("m2_early_stop_carve", "SELECT * FROM gold_parts")
def m2(spark, d):
    return _parts(study(spark, d))


@query("m3_split_report", "SELECT part, count(*) AS rows, CAST(avg(churned) AS DOUBLE) AS churn_rate FROM gold_parts GROUP BY 1")
def m3(spark, d):
    return M.split_report(_parts(study(spark, d)))


@query("m4_class_weight", """
SELECT CAST(count_if(churned = 0) AS DOUBLE) / count_if(churned = 1) AS scale_pos_weight FROM gold_parts WHERE part = 'fit'""")
def m4(spark, d):
    return M.class_weight(_parts(study(spark, d)))


def _m5_sql() -> str:
    q = lambda xs: ", ".join(f"'{x}'" for x in xs)
    cols = "(SELECT column_name AS c FROM (DESCRIBE SELECT * FROM gold))"
    full = f"c NOT IN ({q(M.NON_FEATURES)})"
    return (f"SELECT 'full' AS model, c AS feature FROM {cols} WHERE {full}\nUNION ALL\n"
            f"SELECT 'reduced' AS model, c AS feature FROM {cols} WHERE {full} AND c NOT IN ({q(M.MODEL_2_DROP)}) "
            f"AND NOT starts_with(c, '{M.MODEL_2_DROP_PREFIX}')")


@query("m5_select_features", _m5_sql())
def m5(spark, d):
    g = study(spark, d).gold
    rows = [("full", c) for c in M.select_features(g.columns)] + \
           [("reduced", c) for c in M.select_features(g.columns, reduced=True)]
    return spark.createDataFrame(rows, "model string, feature string")


@query("m9_auc", """
SELECT split, (sum(CASE WHEN churned = 1 THEN r END) - p * (p + 1) / 2.0) / (p * n) AS auc,
       CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives
FROM (SELECT split, churned,
             rank() OVER (PARTITION BY split ORDER BY score) + (count(*) OVER (PARTITION BY split, score) - 1) / 2.0 AS r,
             count_if(churned = 1) OVER (PARTITION BY split) AS p, count_if(churned = 0) OVER (PARTITION BY split) AS n
      FROM scored_fixture)
GROUP BY split, p, n""")
def m9(spark, d):
    return auc(scored_fixture(study(spark, d)), "score", "churned", ["split"])


def _report_sql() -> str:
    c = ("SELECT split, count_if(churned = 0 AND predicted = 0) AS c00, count_if(churned = 0 AND predicted = 1) AS c01, "
         "count_if(churned = 1 AND predicted = 0) AS c10, count_if(churned = 1 AND predicted = 1) AS c11 "
         "FROM scored_fixture WHERE split IN ('val', 'test') GROUP BY 1")
    cls = []
    for k in (0, 1):
        o = 1 - k
        tp, fp, fn = f"c{k}{k}", f"c{o}{k}", f"c{k}{o}"
        prec = f"COALESCE(CAST({tp} AS DOUBLE) / NULLIF({tp} + {fp}, 0), 0.0)"
        rec = f"COALESCE(CAST({tp} AS DOUBLE) / NULLIF({tp} + {fn}, 0), 0.0)"
        cls.append(f"SELECT split, '{k}' AS metric, {prec} AS precision, {rec} AS recall, "
                   f"COALESCE(2 * {prec} * {rec} / NULLIF({prec} + {rec}, 0), 0.0) AS f1, "
                   f"CAST({tp} + {fn} AS DOUBLE) AS support FROM cm")
    per = " UNION ALL ".join(cls)
    return f"""
SELECT * FROM (
  WITH cm AS ({c}), per AS ({per}), tot AS (SELECT split, CAST(c00 + c01 + c10 + c11 AS DOUBLE) AS total, c00 + c11 AS hit FROM cm)
  SELECT * FROM per
  UNION ALL SELECT split, 'accuracy', NULL, NULL, hit / total, total FROM tot
  UNION ALL SELECT split, 'macro avg', avg(precision), avg(recall), avg(f1), (SELECT total FROM tot t WHERE t.split = per.split) FROM per GROUP BY split
  UNION ALL SELECT p.split, 'weighted avg', sum(precision * support) / t.total, sum(recall * support) / t.total,
                   sum(f1 * support) / t.total, t.total FROM per p JOIN tot t USING (split) GROUP BY p.split, t.total)"""


@query("m10_classification_report", _report_sql())
def m10(spark, d):
    sc = scored_fixture(study(spark, d)).where(F.col("split").isin("val", "test"))
    return M.classification_report(sc, by=("split",))


def trained(spark, d, reduced: bool = False):
    s = study(spark, d)
    key = "_model_reduced" if reduced else "_model_full"
    if not hasattr(s, key):
        setattr(s, key, M.train_boosted_trees(s.gold, M.MODEL_2 if reduced else M.MODEL_1, reduced))
    return getattr(s, key)


def _train_summary(spark, tm, name):
    return spark.createDataFrame([(name, len(tm.trees), len(tm.features), tm.scale_pos_weight, sum(t.nodes for t in tm.trees))],
                                 "model string, trees int, features int, scale_pos_weight double, total_nodes int")


@query("m6_train_boosted_trees")
def m6(spark, d):
    return _train_summary(spark, trained(spark, d), "full")


@query("m6_train_boosted_trees_reduced")
def m6b(spark, d):
    return _train_summary(spark, trained(spark, d, True), "reduced")


@query("m6_first_tree_check", "SELECT count(*) AS fit_rows, true AS leaf_values_right, true AS leaves_heavy_enough FROM gold_parts WHERE part = 'fit'")
def m6c(spark, d):
    """The first tree starts from even odds, so each leaf's value follows from the labels of its sampled rows:
    -rate * soft threshold of the gradient sum / (hessian sum + 1), with no leaf below the child weight."""
    tm = trained(spark, d)
    p = tm.params
    drawn = M.tree_margins(tm, tm.data.where(F.col("part") == "fit"))
    w = F.when(F.col(LABEL) == 1, tm.scale_pos_weight).otherwise(1.0)
    use = F.col("_sampled").cast("double")
    leaves = drawn.groupBy("_margin").agg(F.count(F.lit(1)).alias("n"), F.sum(use * w * (0.5 - F.col(LABEL))).alias("g"), F.sum(use * w * 0.25).alias("h"))
    value = -p.learning_rate * F.signum("g") * F.greatest(F.abs("g") - p.l1, F.lit(0.0)) / (F.col("h") + 1)
    return leaves.agg(F.sum("n").alias("fit_rows"), F.every(F.abs(value - F.col("_margin")) < 1e-6).alias("leaf_values_right"),
                      F.every((F.col("h") >= p.min_child_weight - 1e-6) | (F.lit(tm.trees[0].nodes) == 1)).alias("leaves_heavy_enough"))


@query("m7_learning_curve")
def m7(spark, d):
    return M.learning_curve(trained(spark, d))


@query("m7_curve_check", """
SELECT part, true AS trees_in_order, true AS stopped_right, true AS auc_is_that_of_the_scores
FROM gold_parts WHERE part IN ('fit', 'monitor') GROUP BY part""")
def m7c(spark, d):
    """The curve has one row per tree, ends with the patience used up or the last tree, and its AUC at the
    best prefix is the exact AUC of the scores that the kept trees give."""
    tm = trained(spark, d)
    curve = M.learning_curve(tm)
    shape = curve.agg((F.max("trees") == F.count(F.lit(1))).alias("trees_in_order"), F.max("trees").alias("n"),
                      F.min_by("trees", F.struct(-F.col("monitor_auc"), F.col("trees"))).alias("first_best"))
    p = tm.params
    shape = shape.select("trees_in_order", ((F.col("first_best") == tm.best) & F.col("n").isin(tm.best + p.patience, p.max_trees)).alias("stopped_right"))
    at_best = curve.where("is_best = 1").select(F.explode(F.create_map(F.lit("fit"), "fit_auc", F.lit("monitor"), "monitor_auc")).alias("part", "curve_auc"))
    exact = auc(M.score(tm).where(F.col("part").isin("fit", "monitor")), "score", "churned", ["part"])
    return exact.join(at_best, "part").select("part", shape.select("trees_in_order").scalar().alias("trees_in_order"), shape.select("stopped_right").scalar().alias("stopped_right"),
                                              (F.abs(F.col("auc") - F.col("curve_auc")) < 1e-9).alias("auc_is_that_of_the_scores"))


def fold_aucs(spark, d):
    """The models of all folds, grown once per session."""
    s = study(spark, d)
    if not hasattr(s, "_folds"):
        tm = trained(spark, d)
        s._folds = M.fold_aucs(tm, tm.best)
    return s._folds


def cross_validated(spark, d):
    return M.summarised_folds(fold_aucs(spark, d), trained(spark, d).best)


@query("m8_cross_validate")
def m8(spark, d):
    return cross_validated(spark, d)


@query("m8_fold_check", f"""
SELECT CAST(floor({_u_sql(ID, "'fold'", "'42'")} * 5) AS INTEGER) AS fold, CAST(count_if(churned = 1) AS BIGINT) AS positives,
       CAST(count_if(churned = 0) AS BIGINT) AS negatives, true AS auc_in_range
FROM gold_parts WHERE part IN ('fit', 'monitor') GROUP BY 1""")
def m8c(spark, d):
    """Every row of a fold is scored once, by the model that was grown without it."""
    return fold_aucs(spark, d).select("fold", "positives", "negatives", F.col("auc").between(0, 1).alias("auc_in_range"))


@query("m9_model_auc")
def m9m(spark, d):
    return auc(M.score(trained(spark, d)), "score", "churned", ["part"])


@query("m10_model_classification_report")
def m10m(spark, d):
    return M.classification_report(M.score(trained(spark, d)).where(F.col("part").isin("val", "test")))


@query("m11_feature_importance")
def m11(spark, d):
    return M.feature_importance(trained(spark, d))


@query("m12_run_summary")
def m12(spark, d):
    tm = trained(spark, d)
    sc = M.score(tm)
    a = {r["part"]: r["auc"] for r in auc(sc, "score", "churned", ["part"]).collect()}
    sizes = {r["part"]: r["rows"] for r in M.split_report(tm.data).collect()}      # four parts
    p = tm.params
    cv = cross_validated(spark, d).first()
    summary = M.run_summary(spark, {
        "rows": sum(sizes.values()), "features": len(tm.features), "fit_rows": sizes.get("fit", 0),
        "monitor_rows": sizes.get("monitor", 0), "val_rows": sizes.get("val", 0), "test_rows": sizes.get("test", 0),
        "trees_tried": len(tm.monitor), "best_trees": tm.best, "cv_auc_mean": cv.cv_auc_mean, "cv_auc_std": cv.cv_auc_std, "val_auc": a.get("val"), "test_auc": a.get("test"),
        "learning_rate": p.learning_rate, "max_depth": p.max_depth, "row_sample": p.row_sample,
        "column_sample_per_tree": p.column_sample, "min_child_weight": p.min_child_weight,
        "patience": p.patience, "l1_on_leaf_weights": p.l1, "scale_pos_weight": round(tm.scale_pos_weight, 6)})
    path = scratch_path(spark, "run-summary")
    summary.coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


_FEATURE_COUNT = "(SELECT count(*) FROM (DESCRIBE SELECT * FROM gold) WHERE column_name NOT IN ({}))".format(
    ", ".join(f"'{c}'" for c in M.NON_FEATURES))


@query("m12_summary_check", f"""
SELECT part || '_rows' AS metric, CAST(count(*) AS VARCHAR) AS value FROM gold_parts GROUP BY part
UNION ALL SELECT 'rows', CAST(count(*) AS VARCHAR) FROM gold_parts
UNION ALL SELECT 'features', CAST({_FEATURE_COUNT} AS VARCHAR)
UNION ALL SELECT 'scale_pos_weight', CAST(round(CAST(count_if(churned = 0) AS DOUBLE) / count_if(churned = 1), 6) AS VARCHAR) FROM gold_parts WHERE part = 'fit'
UNION ALL SELECT * FROM (VALUES ('learning_rate', '0.05'), ('max_depth', '5'), ('row_sample', '0.8'), ('column_sample_per_tree', '0.8'),
                                ('min_child_weight', '5.0'), ('l1_on_leaf_weights', '0.1'), ('patience', '50'))""")
def m12c(spark, d):
    """The metrics of the run summary that do not depend on the trees."""
    return QUERIES["m12_run_summary"](spark, d).where(~F.col("metric").isin("trees_tried", "best_trees") & ~F.col("metric").contains("auc"))


@query("m11_importance_check", f"SELECT CAST({_FEATURE_COUNT} AS BIGINT) AS features, true AS none_negative, true AS sums_to_one")
def m11c(spark, d):
    """Importance of every feature of the full model: one row each, none negative, 1 in total."""
    imp = M.feature_importance(trained(spark, d), top=None)
    return imp.agg(F.count(F.lit(1)).alias("features"), (F.min("importance") >= 0).alias("none_negative"),
                   (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"))


@query("m13_score_check", "SELECT part, count(*) AS customers, count(*) AS scored FROM gold_parts GROUP BY part")
def m13c(spark, d):
    """Every gold customer has one score in [0, 1] and keeps its part."""
    return M.score(trained(spark, d)).groupBy("part").agg(
        F.count_distinct(ID).alias("customers"), F.count_if(F.col("score").between(0, 1)).alias("scored"))


@query("m13_score_customers")
def m13(spark, d):
    return M.score(trained(spark, d))
