"""Fitted-model queries on ``embeddings`` (label 0 vs rest). Rows-only checks: a fitted
model has no SQL twin. M26 is SQL-checked on the fixed linear scorer, the compiled forms of G1 and S11 on dumped models."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from veritab.catalog.base import LI_KEY, SQL_LI_SCORED, li_scored, query, rounded, sql_round, sql_union, tbl
from veritab.operators import compiled as C
from veritab.operators import evaluate as EV
from veritab.operators import features as FE
from veritab.operators import models as M
from veritab.operators import permute as PE
from veritab.operators import rules as R
from veritab.operators.kernel_svm import KernelSVM
from veritab.session import checkpoint_dir

DIM = 64


def _emb(spark, sf):
    e = tbl(spark, sf, "embeddings").withColumnRenamed("label", "class") \
        .withColumn("label", (F.col("class") == 0).cast("int"))
    return M.prepare(e, "label", ["vec_id"], array_col="embedding", k=5, seed=42)


def _n(df):
    return df.where("fold != 0").count()


def _holdout_metrics(model, df):
    t = M.scored(model, df.where("fold = 0"))
    cm = EV.classification_metrics(t, "label", "prediction")
    rk = EV.ranking_metrics(t, "label", "prediction_probability")
    return rounded(M._one_row_union(cm.select(*EV.METRICS), rk))


@query("m01_logistic_regression")
def m01(spark, sf):
    df = _emb(spark, sf)
    return _holdout_metrics(M.logistic(C=1.0, n=_n(df)).fit(M.training_part(df.where("fold != 0"))), df)


@query("m02_random_forest")
def m02(spark, sf):
    df = _emb(spark, sf)
    return _holdout_metrics(M.random_forest().fit(M.training_part(df.where("fold != 0"))), df)


@query("m03_fourier_svm")
def m03(spark, sf):
    df = _emb(spark, sf)
    model = M.FourierSVM("embedding", DIM).fit(M.training_part(df.where("fold != 0")))
    return _holdout_metrics(model, df)


@query("m03_kernel_svm")
def m03k(spark, sf):
    """Hold-out metrics of the RBF machine with its certificate: duality gap, kernel residual, support vectors."""
    df = _emb(spark, sf)
    train = M.training_part(df.where("fold != 0"))
    model = KernelSVM("embedding", ("vec_id",)).fit(train)
    t = M.calibrated(model, train)(df.where("fold = 0"))
    cm = EV.classification_metrics(t, "label", "prediction")
    rk = EV.ranking_metrics(t, "label", "prediction_probability")
    proof = spark.createDataFrame([(float(model.gap / model.objective if model.objective else 0.0), float(model.kernel_residual), float(model.support))],
                                  "relative_duality_gap double, kernel_residual double, support_vectors double")
    return rounded(M._one_row_union(cm.select(*EV.METRICS), rk, proof))


@query("m04_boosted_trees")
def m04(spark, sf):
    df = _emb(spark, sf)
    return _holdout_metrics(M.boosted_trees("embedding", ["vec_id"]).fit(M.training_part(df.where("fold != 0"))), df)


@query("m07_cross_validation")
def m07(spark, sf):
    df = _emb(spark, sf)
    n = _n(df)
    return rounded(M.cv_metrics(M.cross_validate_logistic(df, "embedding", "vec_id", M.strength(1.0, n))))


@query("m08_coefficient_importance")
def m08(spark, sf):
    df = _emb(spark, sf)
    model = M.logistic(C=1.0, n=_n(df)).fit(df)
    return rounded(M.coefficient_importance(model, [f"f{i}" for i in range(DIM)]))


def _lr_importance(df, model):
    """Importance of all features of a fitted logistic model, ten permutations each."""
    return PE.importance(df, "embedding", "vec_id", [float(w) for w in model.coefficients], float(model.intercept), range(DIM), repeats=10, seed=42)


@query("m09_permutation_importance")
def m09(spark, sf):
    df = _emb(spark, sf)
    return rounded(_lr_importance(df, M.logistic(C=1.0, n=_n(df)).fit(df)))


@query("m17_learning_curve")
def m17(spark, sf):
    df = _emb(spark, sf)
    n = _n(df)
    return rounded(M.learning_curve(df, "embedding", "vec_id", [i / 10 for i in range(1, 11)], M.strength(1.0, n)))


@query("m18_validation_curve")
def m18(spark, sf):
    df = _emb(spark, sf)
    return rounded(M.validation_curve(df, "embedding", "vec_id", np.logspace(-4, 2, 20).tolist(), _n(df)))


@query("m19_grid_search")
def m19(spark, sf):
    df = _emb(spark, sf)
    return rounded(M.grid_search(df, "embedding", "vec_id", {"C": (0.001, 0.01, 0.1, 1.0, 10.0, 100.0), "penalty": ("l1", "l2"),
                                      "solver": ("liblinear", "saga"), "max_iter": (1000, 2000),
                                      "class_weight": ("balanced", None)}, _n(df)))


@query("m20_random_search")
def m20(spark, sf):
    df = _emb(spark, sf)
    space = {"C": np.logspace(-4, 4, 20).tolist(), "penalty": ("l1", "l2", "elasticnet"), "solver": ("liblinear", "saga"),
             "max_iter": (1000, 2000, 3000), "class_weight": ("balanced", None), "l1_ratio": (0.1, 0.3, 0.5, 0.7, 0.9)}
    return rounded(M.random_search(df, "embedding", "vec_id", space, 50, _n(df), seed=42))


@query("m21_evaluate_tuned")
def m21(spark, sf):
    df = _emb(spark, sf)
    train, test = df.where("fold != 0"), df.where("fold = 0")
    # folds for the inner cross-validation: re-assigned on the training rows only
    train = FE.stratified_folds(train.drop("fold"), "label", ["vec_id"], 5, 7)
    n = train.count()
    return rounded(M.evaluate_tuned(train, test, "embedding", "vec_id", M.strength(1.0, n)))


@query("m22_model_comparison")
def m22(spark, sf):
    df = _emb(spark, sf)
    tr, n = M.training_part(df.where("fold != 0")), _n(df)
    fits = {"logistic": lambda: M.logistic(C=1.0, n=n).fit(tr), "random_forest": lambda: M.random_forest().fit(tr),
            "fourier_svm": lambda: M.FourierSVM("embedding", DIM).fit(tr),
            "boosted_trees": lambda: M.boosted_trees("embedding", ["vec_id"]).fit(tr)}
    # the fits do not depend on each other; each is a row of short jobs that leave most cores idle
    parts = M.each(lambda name: _holdout_metrics(fits[name](), df).withColumn("model_name", F.lit(name)), list(fits), df)
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    return M.comparison_table(long, [*EV.METRICS, "roc_auc", "average_precision"])


#: thresholds of three fixed scorers over the same linear score
_LINEAR_MODELS = [("cautious", 0.3), ("even", 0.5), ("strict", 0.7)]


def _linear_comparison_sql():
    cells = sql_union([
        f"SELECT '{name}' AS model_name, SUM(CASE WHEN label = 1 AND score >= {t} THEN 1 ELSE 0 END) AS tp, "
        f"SUM(CASE WHEN label = 0 AND score >= {t} THEN 1 ELSE 0 END) AS fp, SUM(CASE WHEN label = 1 AND score < {t} THEN 1 ELSE 0 END) AS fn, "
        f"SUM(CASE WHEN label = 0 AND score < {t} THEN 1 ELSE 0 END) AS tn FROM ls" for name, t in _LINEAR_MODELS])
    return (f"WITH {SQL_LI_SCORED}, c AS ({cells}), m AS (SELECT model_name, (tp + tn) * 1.0 / (tp + fp + fn + tn) AS accuracy, "
            "CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0 END AS precision, "
            "CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0 END AS recall FROM c), "
            "mf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m) "
            f"SELECT model_name, {sql_round('accuracy')} AS accuracy, {sql_round('precision')} AS precision, {sql_round('recall')} AS recall, "
            f"{sql_round('f1')} AS f1, ROW_NUMBER() OVER (ORDER BY recall DESC, model_name) = 1 AS best FROM mf")


@query("m22_linear_model_comparison", _linear_comparison_sql())
def m22l(spark, sf):
    ls, parts = li_scored(spark, sf), []
    for name, t in _LINEAR_MODELS:
        wide = EV.classification_metrics(ls.withColumn("prediction", (F.col("score") >= t).cast("int")), "label", "prediction")
        parts.append(M._one_row_union(wide.select(*EV.METRICS)).withColumn("model_name", F.lit(name)))
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    return rounded(M.comparison_table(long, EV.METRICS))


@query("m23_ablation")
def m23(spark, sf):
    df = _emb(spark, sf)
    n = _n(df)
    coef = M.logistic(C=1.0, n=n).fit(df).coefficients.toArray()
    top = sorted(range(DIM), key=lambda j: (-abs(coef[j]), j))[:10]
    return rounded(M.ablation(df, "embedding", "vec_id", top, M.strength(1.0, n)))


@query("m25_importance_summary")
def m25(spark, sf):
    df = _emb(spark, sf)
    model = M.logistic(C=1.0, n=_n(df)).fit(df)
    coef = M.coefficient_importance(model, [f"f{i}" for i in range(DIM)])
    perm = _lr_importance(df, model)
    return rounded(M.importance_summary(coef, perm))


@query("s11_model_persistence")
def s11(spark, sf):
    df = _emb(spark, sf)
    pipe = M.as_pipeline(M.logistic(C=1.0, n=_n(df)))
    model = pipe.fit(M.training_part(df.where("fold != 0")))
    path = f"{checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    from veritab.sources.io import load_model, save_model
    save_model(model, path)
    return _holdout_metrics(load_model(path), df)


@query("g01_batch_scoring")
def g01(spark, sf):
    df = _emb(spark, sf)
    model = M.as_pipeline(M.logistic(C=1.0, n=_n(df))).fit(M.training_part(df.where("fold != 0")))
    s = M.scored(model, df)
    return rounded(s.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"),
                                               F.avg("prediction_probability").alias("mean_probability")))


# ---- compiled scoring of dumped models (SQL-checked) ----
_DUMP_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
#: dumped models over these columns
_DUMPS = {
    "linear": {"kind": "linear", "bias": -3.3, "weights": [0.08, 20.0, 10.0]},
    "forest": {"kind": "trees", "link": "mean", "trees": [
        {"feature": 0, "cut": 24.5, "missing": "right", "left": {"leaf": 0.125},
         "right": {"feature": 1, "cut": 0.045, "missing": "left", "left": {"leaf": 0.375}, "right": {"leaf": 0.875}}},
        {"feature": 2, "cut": 0.035, "missing": "right", "left": {"leaf": 0.25}, "right": {"leaf": 0.625}}]},
    "boosted": {"kind": "trees", "link": "logistic", "trees": [
        {"feature": 3, "cut": 40000.0, "missing": "left", "left": {"leaf": -0.4},
         "right": {"feature": 0, "cut": 35.5, "missing": "right", "left": {"leaf": 0.1}, "right": {"leaf": 0.6}}},
        {"feature": 1, "cut": 0.055, "missing": "right", "left": {"leaf": -0.2}, "right": {"leaf": 0.3}}]},
}


def _dumped_scores_sql():
    return sql_union([f"SELECT '{name}' AS model_name, {C.score_sql(d, lambda i: _DUMP_FEATURES[i])} AS p FROM lineitem" for name, d in _DUMPS.items()])


def _dumped_scores(spark, sf, documents):
    li, out = tbl(spark, sf, "lineitem"), None
    for name, d in documents.items():
        s = C.score(li, d, lambda i: F.col(_DUMP_FEATURES[i])).select(F.lit(name).alias("model_name"), "prediction", "prediction_probability")
        out = s if out is None else out.unionByName(s)
    return out


@query("g01_compiled_scoring",
       f"WITH s AS ({_dumped_scores_sql()}) SELECT model_name, CASE WHEN p IS NULL THEN NULL ELSE CAST(p >= 0.5 AS INTEGER) END AS prediction, "
       f"COUNT(*) AS n, {sql_round('AVG(p)')} AS mean_probability FROM s GROUP BY 1, 2")
def g01c(spark, sf):
    return rounded(_dumped_scores(spark, sf, _DUMPS).groupBy("model_name", "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.avg("prediction_probability").alias("mean_probability")))


@query("s11_dumped_models",
       f"WITH s AS ({_dumped_scores_sql()}) SELECT model_name, COUNT(*) AS n, {sql_round('MIN(p)')} AS min_probability, "
       f"{sql_round('MAX(p)')} AS max_probability, {sql_round('AVG(p)')} AS mean_probability FROM s GROUP BY 1")
def s11d(spark, sf):
    folder = f"{checkpoint_dir(spark).rstrip('/')}/models/{uuid.uuid4().hex}"
    for name, d in _DUMPS.items():
        C.write_dump(spark, d, f"{folder}/{name}")
    back = {name: C.read_dump(spark, f"{folder}/{name}") for name in _DUMPS}
    p = F.col("prediction_probability")
    return rounded(_dumped_scores(spark, sf, back).groupBy("model_name").agg(
        F.count(F.lit(1)).alias("n"), F.min(p).alias("min_probability"), F.max(p).alias("max_probability"), F.avg(p).alias("mean_probability")))


# ---- M26 readiness on the fixed linear scorer (SQL-checked) ----
_MD5F = "md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, '42'))"


@query("m26_deployment_readiness",
       f"WITH {SQL_LI_SCORED}, fo AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY label ORDER BY {_MD5F}) - 1) % 5 AS fold FROM ls), "
       "c AS (SELECT fold, SUM(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp, "
       "SUM(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS fp, "
       "SUM(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS fn, "
       "SUM(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS tn FROM fo GROUP BY fold), "
       "m AS (SELECT (tp + tn) * 1.0 / (tp + fp + fn + tn) AS accuracy, CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0 END AS precision, "
       "CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0 END AS recall FROM c), "
       "mf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m), "
       "mt AS (SELECT 'accuracy' AS metric, AVG(accuracy) AS value FROM mf UNION ALL SELECT 'precision', AVG(precision) FROM mf "
       "UNION ALL SELECT 'recall', AVG(recall) FROM mf UNION ALL SELECT 'f1', AVG(f1) FROM mf), "
       "r AS (SELECT * FROM (VALUES ('accuracy', 0.85), ('recall', 0.9), ('precision', 0.8), ('f1', 0.85)) r(metric, lim)) "
       "SELECT COUNT(*) AS rules_checked, COUNT(*) FILTER (WHERE value < lim) AS rules_fired, "
       "COALESCE(BOOL_AND(NOT (value < lim)), TRUE) AS ready FROM mt JOIN r ON mt.metric = r.metric")
def m26(spark, sf):
    f = FE.stratified_folds(li_scored(spark, sf), "label", LI_KEY, 5, 42)
    wide = EV.classification_metrics(f, "label", "prediction", ["fold"])
    means = EV.fold_range(EV.metrics_long(wide, ["fold"])).select(
        F.lit(None).cast("string").alias("scope"), "metric", F.col("mean").alias("value"))
    return R.readiness(means, R.rule_table(spark, R.PERFORMANCE_RULES[:4]))
