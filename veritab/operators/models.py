"""Fitted models (M1-M4, M7-M9, M17-M23, M25, S11, G1) with Spark ML.

Folds come from the exact md5 fold column (M6), so cross-validation, search and curves
are reproducible; their logistic fits go through :mod:`batched`, all in one pass.
Evaluation of out-of-fold predictions reuses the grouped metric aggregates.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from veritab.operators import evaluate as EV
from veritab.operators import batched as B
from veritab.operators.boosting import BoostedTrees
from veritab.operators.kernel_svm import KernelModel
from veritab.operators.features import balanced_weights, stratified_folds
from veritab.session import run_table


# ---------------- inputs ----------------
def vectorize(df: DataFrame, array_col: str | None = None, cols: Sequence[str] = (),
              out: str = "features") -> DataFrame:
    """Feature vector from an array column or from numeric columns."""
    if array_col:
        return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def prepare(df: DataFrame, label: str, key: Sequence[str], array_col: str | None = None,
            cols: Sequence[str] = (), k: int = 5, seed=42) -> DataFrame:
    """Features vector, balanced class weight (M5) and exact stratified fold (M6)."""
    v = vectorize(df, array_col, cols)
    w = balanced_weights(v, label, "weight")
    # iterative fits read this frame many times: written once in the shared folder, dropped with the run
    return run_table(stratified_folds(w, label, key, k, seed))


def training_part(df: DataFrame) -> DataFrame:
    """Rows for one fit, with the balanced class weights (M5) of these rows only."""
    if "weight" not in df.columns:
        return df
    return balanced_weights(df.drop("weight"), "label", "weight")


def each(work: Callable, items: Sequence, df: DataFrame, parallelism: int = 4) -> list:
    """``work`` of every item in order; ``parallelism`` of them submit their jobs at once."""
    tasks = [inheritable_thread_target(df.sparkSession)(lambda x=x: work(x)) for x in items]
    with ThreadPool(parallelism) as pool:
        return pool.map(lambda task: task(), tasks, chunksize=1)


# ---------------- M1-M4 estimators ----------------
def logistic(C: float = 1.0, n: int = 1, penalty: str = "l2", l1_ratio: float = 0.5,
             max_iter: int = 1000, weighted: bool = True) -> LogisticRegression:
    """M1: ``regParam = 1 / (C * n)`` maps the inverse-strength C of a per-sample loss sum."""
    enet = {"l2": 0.0, "l1": 1.0, "elasticnet": l1_ratio}[penalty]
    return LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter,
                              regParam=1.0 / (C * max(n, 1)), elasticNetParam=enet, standardization=False,
                              weightCol="weight" if weighted else None)


def random_forest(num_trees: int = 100, max_depth: int = 10, min_leaf: int = 2, seed: int = 42,
                  weighted: bool = True) -> RandomForestClassifier:
    """M2: 100 trees, depth 10, at least 2 rows per leaf, balanced weights."""
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=num_trees,
                                  maxDepth=max_depth, minInstancesPerNode=min_leaf, seed=seed,
                                  weightCol="weight" if weighted else None)


def boosted_trees(array_col: str, key: Sequence[str], rounds: int = 100, max_depth: int = 6, rate: float = 0.1,
                  subsample: float = 0.8, col_sample: float = 0.8, pos_weight: float = 1.7, seed: int = 42) -> BoostedTrees:
    """M4: 100 rounds, depth 6, step 0.1, row and feature sampling 0.8, positive class weight 1.7."""
    return BoostedTrees(array_col, tuple(key), rounds=rounds, max_depth=max_depth, rate=rate, subsample=subsample,
                        col_sample=col_sample, pos_weight=pos_weight, seed=seed)


def fourier_features(df: DataFrame, array_col: str, dim: int, n_components: int = 100,
                     gamma: float | None = None, seed: int = 42, out: str = "features") -> DataFrame:
    """Random Fourier features (Rahimi & Recht 2007) approximating the RBF kernel
    ``exp(-gamma |x - y|^2)``: ``sqrt(2/D) cos(W x + b)``, ``W ~ N(0, 2 gamma)``,
    ``b ~ U(0, 2 pi)``. ``gamma=None`` is the 'scale' rule ``1 / (dim * Var(x))`` from one
    aggregate. W is a parameter-sized literal (components x dim), not data."""
    if gamma is None:
        var = df.select(F.explode(F.col(array_col)).alias("v")).agg(F.var_pop("v")).first()[0] or 1.0
        gamma = 1.0 / (dim * var)
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2 * gamma), size=(n_components, dim))
    b = rng.uniform(0, 2 * math.pi, size=n_components)
    scale = math.sqrt(2.0 / n_components)

    # a dense (rows x dim) @ (dim x D) product per Arrow batch: vectorized in numpy
    @pandas_udf("array<double>")
    def project(x: pd.Series) -> pd.Series:
        m = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, dim))
        z = np.cos(m @ w.T + b) * scale
        return pd.Series(list(z))

    return df.withColumn(out, array_to_vector(project(F.col(array_col).cast("array<double>"))))


class FourierSVM:
    """M3 (approximation, named so): RBF SVM as random Fourier features -> LinearSVC ->
    Platt scaling (a 1-D logistic regression on the margin) for probabilities."""

    def __init__(self, array_col: str, dim: int, C: float = 1.0, n_components: int = 100, seed: int = 42):
        self.array_col, self.dim, self.C, self.nc, self.seed = array_col, dim, C, n_components, seed
        self.gamma = None

    def fit(self, df: DataFrame):
        if self.gamma is None:
            var = df.select(F.explode(F.col(self.array_col)).alias("v")).agg(F.var_pop("v")).first()[0] or 1.0
            self.gamma = 1.0 / (self.dim * var)
        z = fourier_features(df, self.array_col, self.dim, self.nc, self.gamma, self.seed) \
            .persist(StorageLevel.MEMORY_AND_DISK)
        n = z.count()
        self.svm = LinearSVC(featuresCol="features", labelCol="label", regParam=1.0 / (self.C * max(n, 1)),
                             weightCol="weight", maxIter=100).fit(z)
        m = self.svm.transform(z).withColumn("margin", vector_to_array("rawPrediction")[1]) \
            .drop("prediction", "rawPrediction")
        m = VectorAssembler(inputCols=["margin"], outputCol="mfeat").transform(m)
        self.platt = LogisticRegression(featuresCol="mfeat", labelCol="label", regParam=0.0).fit(m)
        z.unpersist()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        z = fourier_features(df, self.array_col, self.dim, self.nc, self.gamma, self.seed)
        m = self.svm.transform(z).withColumnRenamed("prediction", "svm_prediction") \
            .withColumn("margin", vector_to_array("rawPrediction")[1]).drop("rawPrediction")
        m = VectorAssembler(inputCols=["margin"], outputCol="mfeat").transform(m)
        return self.platt.transform(m)


def calibrated(model: KernelModel, train: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Platt scaling of a kernel machine: a 1-D logistic regression on the training margins gives
    ``prediction_probability``; ``prediction`` is the margin's sign. Rows without a margin are left out."""
    def margins(df: DataFrame) -> DataFrame:
        m = model.transform(df).where("margin IS NOT NULL").drop("features")
        return VectorAssembler(inputCols=["margin"], outputCol="features").transform(m)

    platt = LogisticRegression(featuresCol="features", labelCol="label", regParam=0.0, predictionCol="").fit(margins(train))
    return lambda df: platt.transform(margins(df)).withColumn("prediction_probability", vector_to_array("probability")[1])


def fit(estimator, df: DataFrame):
    return estimator.fit(df)


def scored(model, df: DataFrame) -> DataFrame:
    """G1: transform, then the class-1 probability as a plain column."""
    return model.transform(df).withColumn("prediction_probability", vector_to_array("probability")[1]) \
        .withColumn("prediction", F.col("prediction").cast("int"))


# ---------------- M7 cross-validation ----------------
def cross_validate(df: DataFrame, make: Callable[[], object], fold_col: str = "fold") -> DataFrame:
    """M7: one fit per fold; out-of-fold predictions of all folds as one frame
    (``fold, label, prediction, prediction_probability``)."""
    folds = sorted(r[0] for r in df.select(fold_col).distinct().collect())  # k values
    parts = []
    for f in folds:
        model = make().fit(training_part(df.where(F.col(fold_col) != f)))
        parts.append(scored(model, df.where(F.col(fold_col) == f))
                     .select(fold_col, "label", "prediction", "prediction_probability"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def strength(C: float, n: int) -> float:
    """``lam`` of a batched fit for the inverse strength C of a sum over n rows (as in :func:`logistic`)."""
    return 1.0 / (C * max(n, 1))


def _folds(df: DataFrame, fold_col: str) -> list[int]:
    return sorted(r[0] for r in df.select(fold_col).distinct().collect())  # k values


def cross_validate_logistic(df: DataFrame, array_col: str, key: str, lam: float, fold_col: str = "fold") -> DataFrame:
    """M7 of the logistic model: the fits of all folds in one pass; out-of-fold predictions as
    :func:`cross_validate` gives them."""
    folds = _folds(df, fold_col)
    beta, _ = B.fit_many(B.rows_of(df, array_col, key, fold_col=fold_col), [B.Fit(lam, fold=f) for f in folds])
    return B.out_of_fold(df, array_col, dict(zip(folds, beta, strict=True)), fold_col)


def cv_metrics(oof: DataFrame, fold_col: str = "fold") -> DataFrame:
    """M7 metrics: per fold accuracy, precision, recall, F1, ROC-AUC; then mean, std (n),
    min, max over folds (W5)."""
    cm = EV.classification_metrics(oof, "label", "prediction", [fold_col])
    auc = EV.roc_auc(oof, "label", "prediction_probability", [fold_col])
    long = EV.metrics_long(cm.join(auc, fold_col), [fold_col], (*EV.METRICS, "roc_auc"))
    return EV.fold_range(long, fold_col)


# ---------------- M8 / M9 importance ----------------
def coefficient_importance(model, names: Sequence[str]) -> DataFrame:
    """M8: coefficient and |coefficient| per feature, sorted descending by |coefficient|."""
    coef = model.coefficients.toArray().tolist()
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    rows = [(n, float(c), float(abs(c))) for n, c in zip(names, coef)]
    return s.createDataFrame(rows, "feature string, coefficient double, abs_coefficient double") \
        .orderBy(F.desc("abs_coefficient"), "feature")


def permuted_element(df: DataFrame, array_col: str, index: int, key: str, seed) -> DataFrame:
    """Replace element ``index`` of every row's array with the value of another row,
    the pairing being two orderings of the rows: by key and by md5(key|index|seed). Both
    ranks come from distributed ranking; the pairing is an equi-join on rank."""
    from veritab.operators.features import _class_rank
    base = df.withColumn("_one", F.lit(1))
    a = _class_rank(base, "_one", [key], seed=f"a{seed}").select(key, F.col("_rank").alias("_r"))
    b = _class_rank(base, "_one", [key, F.lit(index)], seed=seed).select(
        F.col("_rank").alias("_r"), F.element_at(F.col(array_col), index + 1).alias("_v"))
    pair = a.join(b, "_r").select(key, "_v")
    j = df.join(pair, key)
    return j.withColumn(array_col, F.transform(F.col(array_col), lambda v, i: F.when(i == index, F.col("_v"))
                                               .otherwise(v))).drop("_v")


def permuted_elements(df: DataFrame, array_col: str, indices: Sequence[int], key: str, seed) -> DataFrame:
    """``permuted_element`` of every index in one frame: each row once per index ``_j``. The ranks of
    all indices come from one distributed ranking; the arrays meet their values by key."""
    from veritab.operators.features import _class_rank
    a = _class_rank(df.withColumn("_one", F.lit(1)), "_one", [key], seed=f"a{seed}").select(key, F.col("_rank").alias("_r"))
    values = df.select(key, F.explode(F.array(*[F.struct(F.lit(i).alias("_j"), F.element_at(F.col(array_col), i + 1).alias("_v"))
                                                for i in indices])).alias("_x")).select(key, "_x.*")
    b = _class_rank(values, "_j", [key, "_j"], seed=seed, copies=len(indices)).select(F.col("_rank").alias("_r"), "_j", "_v")
    j = df.join(a.join(b, "_r").select(key, "_j", "_v"), key)
    return j.withColumn(array_col, F.transform(F.col(array_col), lambda v, i: F.when(i == F.col("_j"), F.col("_v"))
                                               .otherwise(v))).drop("_v")


def permutation_importance(model_fn, df: DataFrame, array_col: str, indices: Sequence[int], key: str,
                           repeats: int = 10, seed=42, metric: str = "recall") -> DataFrame:
    """M9: mean and std (n) over repeats of ``baseline - permuted`` metric per feature.
    ``model_fn(frame) -> scored frame`` keeps further columns; each repeat is one distributed job
    over all features."""
    base = EV.classification_metrics(model_fn(df), "label", "prediction").select(metric).first()[0]

    def drops(r):
        p = model_fn(permuted_elements(df, array_col, indices, key, f"{seed}-{r}"))
        return {x["_j"]: base - x[metric] for x in EV.classification_metrics(p, "label", "prediction", ["_j"]).collect()}

    found = each(drops, range(repeats), df)
    rows = [(j, float(np.mean([x[j] for x in found])), float(np.std([x[j] for x in found]))) for j in indices]
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession().createDataFrame(
        rows, "feature_index int, importance_mean double, importance_std double") \
        .orderBy(F.desc("importance_mean"), "feature_index")


# ---------------- M17-M21 curves and search ----------------
# All logistic fits of a curve, search or ablation go through ``batched``: one scan per step for all of
# them, class weights from each fit's own rows.
def _recalls(df: DataFrame, array_col: str, key: str, fits: Sequence[B.Fit], fold_col: str, seed=42) -> tuple[np.ndarray, np.ndarray]:
    """(train, validation) recall of every fit."""
    rows = B.rows_of(df, array_col, key, fold_col=fold_col, seed=seed)
    found = B.confusions(rows, fits, B.fit_many(rows, fits)[0])
    return tuple(np.array([found[i, part]["recall"] for i in range(len(fits))]) for part in ("train", "validation"))  # type: ignore[return-value]


def learning_curve(df: DataFrame, array_col: str, key: str, sizes: Sequence[float], lam: float, fold_col: str = "fold",
                   seed=42) -> DataFrame:
    """Recall on train and validation for nested train fractions (md5 prefixes) per fold; mean
    and std over folds, and the final gap."""
    folds = _folds(df, fold_col)
    fits = [B.Fit(lam, fold=f, fraction=float(s)) for s in sizes for f in folds]
    train, val = (x.reshape(len(sizes), len(folds)) for x in _recalls(df, array_col, key, fits, fold_col, seed))
    rows = [(float(s), float(t.mean()), float(t.std()), float(v.mean()), float(v.std())) for s, t, v in zip(sizes, train, val, strict=True)]
    out = df.sparkSession.createDataFrame(
        rows, "train_fraction double, train_mean double, train_std double, val_mean double, val_std double")
    return out.withColumn("gap", F.col("train_mean") - F.col("val_mean"))


def validation_curve(df: DataFrame, array_col: str, key: str, Cs: Sequence[float], n: int, fold_col: str = "fold") -> DataFrame:
    """Recall of the logistic model on train and validation rows per fold over a grid of C;
    mean and std over folds; best C by validation recall flagged."""
    folds = _folds(df, fold_col)
    fits = [B.Fit(strength(C, n), fold=f) for C in Cs for f in folds]
    train, val = (x.reshape(len(Cs), len(folds)) for x in _recalls(df, array_col, key, fits, fold_col))
    rows = [(float(C), float(v.mean()), float(v.std()), float(t.mean()), float(t.std())) for C, t, v in zip(Cs, train, val, strict=True)]
    out = df.sparkSession.createDataFrame(rows, "C double, recall_mean double, recall_std double, train_mean double, train_std double")
    best = min(rows, key=lambda r: (-r[1], r[0]))[0]
    return out.withColumn("best", F.col("C") == F.lit(best))


def grid_search(df: DataFrame, array_col: str, key: str, grid: Mapping[str, Sequence], n: int, fold_col: str = "fold") -> DataFrame:
    """Every combination of the grid, validated on the fold column by recall of class 1.
    ``grid`` keys: ``C``, ``penalty``, ``solver``, ``max_iter``, ``class_weight`` (``balanced``/None), ``l1_ratio``.
    Fits end at their optimum, so combinations that differ in solver or max_iter alone are listed each
    and fitted once."""
    combos = [dict(zip(grid, v)) for v in itertools.product(*grid.values())]
    return _search(df, array_col, key, combos, n, fold_col)


def random_search(df: DataFrame, array_col: str, key: str, space: Mapping[str, Sequence], draws: int, n: int, seed: int = 42,
                  fold_col: str = "fold") -> DataFrame:
    """``draws`` combinations drawn without replacement (seeded) from the space. A combination
    whose solver cannot fit its penalty (liblinear with elasticnet) is not fitted: it has no recall and
    ranks last."""
    combos = [dict(zip(space, v)) for v in itertools.product(*space.values())]
    picked = random.Random(seed).sample(combos, min(draws, len(combos)))
    return _search(df, array_col, key, picked, n, fold_col)


def _setting(c: dict, n: int) -> tuple[float, float, bool] | None:
    """(lam, alpha, balanced) of a combination, None for an invalid one."""
    penalty = c.get("penalty", "l2")
    if penalty == "elasticnet" and c.get("solver") == "liblinear":
        return None
    alpha = {"l2": 0.0, "l1": 1.0, "elasticnet": float(c.get("l1_ratio", 0.5))}[penalty]
    return strength(float(c.get("C", 1.0)), n), alpha, c.get("class_weight") == "balanced"


def _search(df: DataFrame, array_col: str, key: str, combos: list[dict], n: int, fold_col: str) -> DataFrame:
    settings = [_setting(c, n) for c in combos]
    different = sorted({x for x in settings if x is not None})
    folds = _folds(df, fold_col)
    fits = [B.Fit(lam, alpha, fold=f, balanced=balanced) for lam, alpha, balanced in different for f in folds]
    recall = _recalls(df, array_col, key, fits, fold_col)[1].reshape(len(different), len(folds)) if fits else np.zeros((0, 1))
    at = {x: i for i, x in enumerate(different)}
    rows = [(i, str(sorted(c.items())), *((float(recall[at[x]].mean()), float(recall[at[x]].std())) if x is not None else (None, None)))
            for i, (c, x) in enumerate(zip(combos, settings, strict=True))]
    out = df.sparkSession.createDataFrame(rows, "candidate int, params string, recall_mean double, recall_std double")
    # ranking over the candidate table (one row per candidate)
    return out.withColumn("rank", F.dense_rank().over(Window.orderBy(F.desc_nulls_last("recall_mean"))))


def evaluate_tuned(train: DataFrame, test: DataFrame, array_col: str, key: str, lam: float, fold_col: str = "fold") -> DataFrame:
    """Test metrics of the model fitted on all training rows, plus fold-mean F1 and accuracy
    from cross-validation on the training rows; all fits in one pass."""
    folds = _folds(train, fold_col)
    beta, _ = B.fit_many(B.rows_of(train, array_col, key, fold_col=fold_col), [B.Fit(lam), *[B.Fit(lam, fold=f) for f in folds]])
    t = test.withColumn("prediction_probability", B.linear_probability(array_col, beta[0])) \
        .withColumn("prediction", (F.col("prediction_probability") >= 0.5).cast("int"))
    cm = EV.classification_metrics(t, "label", "prediction")
    rk = EV.ranking_metrics(t, "label", "prediction_probability")
    oof = B.out_of_fold(train, array_col, dict(zip(folds, beta[1:], strict=True)), fold_col)
    cvm = EV.classification_metrics(oof, "label", "prediction", [fold_col]).agg(
        F.avg("f1").alias("cv_f1_mean"), F.avg("accuracy").alias("cv_accuracy_mean"))
    return _one_row_union(cm, rk, cvm)


def _one_row_union(*frames: DataFrame) -> DataFrame:
    """Side by side of one-row frames, as a long-then-wide step without a cross join."""
    longs = [f.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                                         for c in f.columns]))) for f in frames]
    u = longs[0]
    for l in longs[1:]:
        u = u.unionByName(l)
    return u


# ---------------- M23 ablation ----------------
def ablation(df: DataFrame, array_col: str, key: str, indices: Sequence[int], lam: float, fold_col: str = "fold") -> DataFrame:
    """Refit without each listed feature; drop in recall, F1 and accuracy (baseline minus
    ablated) of the out-of-fold predictions of all folds together. All fits in one pass."""
    folds = _folds(df, fold_col)
    sets = [(), *[(j,) for j in indices]]
    fits = [B.Fit(lam, fold=f, without=x) for x in sets for f in folds]
    rows = B.rows_of(df, array_col, key, fold_col=fold_col)
    found = B.confusions(rows, fits, B.fit_many(rows, fits)[0])
    pooled = [B.metrics_of(np.sum([found[i * len(folds) + f, "validation"]["cells"] for f in range(len(folds))], axis=0)) for i in range(len(sets))]
    base = pooled[0]
    out = [(int(j), *(base[m] - x[m] for m in ("recall", "f1", "accuracy"))) for j, x in zip(indices, pooled[1:], strict=True)]
    return df.sparkSession.createDataFrame(out, "feature_index int, recall_drop double, f1_drop double, accuracy_drop double")


# ---------------- M22 comparison ----------------
def comparison_table(long: DataFrame, metrics: Sequence[str], by: str = "recall") -> DataFrame:
    """One row per model from ``(model_name, metric, value)`` rows, the best by ``by`` (ties:
    the first name) flagged."""
    wide = long.groupBy("model_name").pivot("metric", list(metrics)).agg(F.first("value"))
    best = wide.orderBy(F.desc(by), "model_name").limit(1).select(F.col("model_name").alias("_best"))
    return wide.join(F.broadcast(best), F.col("model_name") == F.col("_best"), "left") \
        .withColumn("best", F.col("_best").isNotNull()).drop("_best")


# ---------------- M25 summary ----------------
def importance_summary(coef: DataFrame, perm: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` by |coefficient| and by permutation importance (J2 join on feature)."""
    c = coef.orderBy(F.desc("abs_coefficient"), "feature").limit(k) \
        .select(F.lit("coefficient").alias("kind"), "feature", F.col("abs_coefficient").alias("score"))
    p = perm.orderBy(F.desc("importance_mean"), "feature_index").limit(k) \
        .select(F.lit("permutation").alias("kind"), F.concat(F.lit("f"), F.col("feature_index").cast("string"))
                .alias("feature"), F.col("importance_mean").alias("score"))
    return c.unionByName(p)


# ---------------- S11 persistence ----------------
def as_pipeline(*stages) -> Pipeline:
    return Pipeline(stages=list(stages))
