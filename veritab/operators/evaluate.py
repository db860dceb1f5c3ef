"""Classifier evaluation on scored tables.

Every metric is a grouped aggregate, so the same code serves a whole table, a side,
a fold or a stream window; bootstrap replicates come from :mod:`resample`. Ranking metrics (ROC-AUC, average
precision) use the distributed running sums over distinct scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.functions.scalar import col_of, direction_word
from veritab.operators import resample
from veritab.operators.cumulative import running_sums
from veritab.session import run_table

METRICS = ("accuracy", "precision", "recall", "f1")


def _w(weight: str | None) -> Column:
    return col_of(weight).cast("double") if weight else F.lit(1)


def _cells(label: str, pred: str, weight: str | None = None) -> list[Column]:
    y, p, w = col_of(label), col_of(pred), _w(weight)
    return [F.sum(F.when((y == 1) & (p == 1), w).otherwise(0)).alias("tp"),
            F.sum(F.when((y == 0) & (p == 1), w).otherwise(0)).alias("fp"),
            F.sum(F.when((y == 1) & (p == 0), w).otherwise(0)).alias("fn"),
            F.sum(F.when((y == 0) & (p == 0), w).otherwise(0)).alias("tn")]


def _safe(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def metric_columns(tp="tp", fp="fp", fn="fn", tn="tn") -> list[Column]:
    """M11 formulas of confusion cells; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in (tp, fp, fn, tn))
    prec, rec = _safe(tp, tp + fp), _safe(tp, tp + fn)
    return [_safe(tp + tn, tp + fp + fn + tn).alias("accuracy"), prec.alias("precision"),
            rec.alias("recall"), _safe(2 * prec * rec, prec + rec).alias("f1")]


def confusion(df: DataFrame, label: str, pred: str, by: Sequence[str] = (),
              weight: str | None = None) -> DataFrame:
    """2x2 confusion as rows ``(by..., actual, predicted, n)``; zero cells kept."""
    g = df.groupBy(*by).agg(*_cells(label, pred, weight))
    return g.select(*by, F.inline(F.array(
        F.struct(F.lit(0).alias("actual"), F.lit(0).alias("predicted"), F.col("tn").alias("n")),
        F.struct(F.lit(0).alias("actual"), F.lit(1).alias("predicted"), F.col("fp").alias("n")),
        F.struct(F.lit(1).alias("actual"), F.lit(0).alias("predicted"), F.col("fn").alias("n")),
        F.struct(F.lit(1).alias("actual"), F.lit(1).alias("predicted"), F.col("tp").alias("n")))))


def classification_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = (),
                           weight: str | None = None) -> DataFrame:
    """Accuracy, precision, recall, F1 of class 1 per group, with the cells."""
    g = df.groupBy(*by).agg(*_cells(label, pred, weight))
    return g.select(*by, "tp", "fp", "fn", "tn", *metric_columns())


def metrics_long(wide: DataFrame, by: Sequence[str] = (), metrics: Sequence[str] = METRICS) -> DataFrame:
    return wide.select(*by, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"),
                                                        F.col(m).cast("double").alias("value")) for m in metrics])))


def per_class_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support for each class (0 and 1)."""
    g = df.groupBy(*by).agg(*_cells(label, pred))
    rows = []
    for c, (tp, fp, fn) in {1: ("tp", "fp", "fn"), 0: ("tn", "fn", "fp")}.items():
        tpc, fpc, fnc = (F.col(x).cast("double") for x in (tp, fp, fn))
        prec, rec = _safe(tpc, tpc + fpc), _safe(tpc, tpc + fnc)
        rows.append(F.struct(F.lit(c).alias("class"), prec.alias("precision"), rec.alias("recall"),
                             _safe(2 * prec * rec, prec + rec).alias("f1"),
                             (tpc + fnc).cast("long").alias("support")))
    return g.select(*by, F.inline(F.array(*rows)))


def _ranked(df: DataFrame, label: str, score: str, by: Sequence[str], weight: str | None) -> DataFrame:
    y, w = col_of(label), _w(weight)
    return running_sums(df.where(col_of(score).isNotNull()).withColumn("_s", col_of(score).cast("double")),
                        "_s", {"pos": F.when(y == 1, w).otherwise(0), "neg": F.when(y == 0, w).otherwise(0)},
                        by=by)


def ranking_metrics(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
                    weight: str | None = None) -> DataFrame:
    """M12 + M13 from one ranked frame.

    ROC-AUC by the Mann-Whitney count (ties count one half):
    ``sum_s pos(s) * (neg below s + neg(s) / 2) / (P * N)``.
    Average precision as the step sum ``sum (R_i - R_{i-1}) P_i`` over distinct
    thresholds from the top; no interpolation."""
    r = _ranked(df, label, score, by, weight)
    below = F.col("cum_neg") - F.col("neg")
    tp = F.col("tot_pos") - (F.col("cum_pos") - F.col("pos"))
    fp = F.col("tot_neg") - (F.col("cum_neg") - F.col("neg"))
    g = r.groupBy(*by).agg(F.sum(F.col("pos") * (below + F.col("neg") / 2)).alias("_u"),
                           F.sum(F.when(F.col("pos") > 0, F.col("pos") * tp / (tp + fp))).alias("_s"),
                           F.max("tot_pos").alias("_p"), F.max("tot_neg").alias("_n"))
    auc = F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_u") / (F.col("_p") * F.col("_n")))
    ap = F.when(F.col("_p") > 0, F.coalesce(F.col("_s"), F.lit(0.0)) / F.col("_p"))
    return g.select(*by, auc.alias("roc_auc"), ap.alias("average_precision"))


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
            weight: str | None = None) -> DataFrame:
    """ROC-AUC (see :func:`ranking_metrics`)."""
    return ranking_metrics(df, label, score, by, weight).select(*by, "roc_auc")


def average_precision(df: DataFrame, label: str, score: str, by: Sequence[str] = (),
                      weight: str | None = None) -> DataFrame:
    """Average precision (see :func:`ranking_metrics`)."""
    return ranking_metrics(df, label, score, by, weight).select(*by, "average_precision")


def bootstrap_metrics(df: DataFrame, label: str, pred: str, score: str, replicates: int = 1000, seed=42) -> DataFrame:
    """Per replicate accuracy, precision, recall, F1, ROC-AUC and average precision, from one
    scoring (no refit per replicate) and one draw per cell of equal rows (:mod:`resample`); long rows
    ``(replicate, metric, value)``."""
    wide = resample.replicate_metrics(df, label, pred, score, replicates, seed)
    return metrics_long(wide, ["replicate"], (*METRICS, "roc_auc", "average_precision"))


def bootstrap_summary(long: DataFrame) -> DataFrame:
    """Per metric mean, population std and linear percentiles 2.5/97.5 and 0.5/99.5
    over replicates (a group holds one value per replicate: bounded by the parameter)."""
    return long.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
        F.percentile("value", 0.025).alias("ci95_low"), F.percentile("value", 0.975).alias("ci95_high"),
        F.percentile("value", 0.005).alias("ci99_low"), F.percentile("value", 0.995).alias("ci99_high"))


def error_analysis(df: DataFrame, label: str, pred: str, prob: str) -> DataFrame:
    """Errors, false positives, false negatives, mean probability of errors; zero
    counts (not a missing report) when there is no error."""
    y, p = col_of(label), col_of(pred)
    err = y != p
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(err).alias("errors"),
                  F.count_if((y == 0) & (p == 1)).alias("false_positives"),
                  F.count_if((y == 1) & (p == 0)).alias("false_negatives"),
                  F.avg(F.when(err, col_of(prob))).alias("mean_error_probability"))


def fold_range(long: DataFrame, group: str = "fold") -> DataFrame:
    """Per metric mean, population std, min and max over folds."""
    return long.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
                                      F.min("value").alias("min"), F.max("value").alias("max"),
                                      F.count(F.lit(1)).alias("n_folds"))


def performance_by_side(tagged: DataFrame, label: str, pred: str, side_col: str = "side") -> DataFrame:
    """V1: metrics of both sides."""
    return classification_metrics(tagged, label, pred, [side_col])


def performance_drift(tagged: DataFrame, label: str, pred: str, side_col: str = "side") -> DataFrame:
    """V3: per metric reference, current, absolute and relative drift ``(cur-ref)/ref``
    (relative only where ref > 0) and its direction."""
    wide = classification_metrics(tagged, label, pred, [side_col])
    long = metrics_long(wide, [side_col])
    p = long.groupBy("metric").agg(F.max(F.when(F.col(side_col) == "reference", F.col("value"))).alias("reference"),
                                   F.max(F.when(F.col(side_col) == "current", F.col("value"))).alias("current"))
    drift = F.col("current") - F.col("reference")
    return p.select("metric", "reference", "current", drift.alias("drift"),
                    F.when(F.col("reference") > 0, drift / F.col("reference")).alias("relative_drift"),
                    direction_word(drift).alias("direction"))


def performance_trends(drift: DataFrame, limit: float = 0.05) -> DataFrame:
    """V5: metrics whose absolute drift is over ``limit``, with direction."""
    return drift.where(F.abs("drift") > limit).select("metric", "drift", "direction")


# ---------------------------------------------------------------------------
# Joins used by the reports (J1, J2, J4) and linear-scorer permutation importance (M9)
# ---------------------------------------------------------------------------
def pair_sides(long: DataFrame, keys: Sequence[str] = ("feature", "metric"), side_col: str = "side") -> DataFrame:
    """Reference and current values of each (feature, metric) side by side, with the
    absolute delta and the relative change where the reference is > 0."""
    ref = long.where(F.col(side_col) == "reference").select(*keys, F.col("value").alias("reference"))
    cur = long.where(F.col(side_col) == "current").select(*keys, F.col("value").alias("current"))
    j = ref.join(cur, list(keys), "inner")
    return j.select(*keys, "reference", "current", (F.col("current") - F.col("reference")).alias("delta"),
                    F.when(F.col("reference") > 0, (F.col("current") - F.col("reference")) / F.col("reference"))
                    .alias("relative"))


def permutation_pairs(df: DataFrame, features: Sequence[str], key: Sequence[str], repeats: int,
                      seed=42, carry: Sequence[str] = ()) -> DataFrame:
    """For every (feature, repeat) each row receives the feature value of the row with
    the same rank in md5(key|feature|repeat|seed) order as its own rank in md5(key|seed)
    order. Gives key, ``carry``, feature, repeat, original, permuted (:mod:`veritab.operators.pairs`)."""
    from veritab.operators import pairs
    return pairs.permutation_pairs(df, features, key, repeats, seed, carry)


def linear_permutation_importance(df: DataFrame, weights: Mapping[str, float], bias: float, label: str,
                                  key: Sequence[str], repeats: int = 10, seed=42,
                                  metric: str = "recall", score_digits: int = 9) -> DataFrame:
    """M9 for a linear scorer, every feature and repeat in one job: the permuted score is
    ``z + w_j (x'_j - x_j)``; metric drop = baseline - permuted, mean and std (n)."""
    from veritab.operators import pairs
    z = sum((col_of(c).cast("double") * float(w) for c, w in weights.items()), F.lit(float(bias)))
    cells = run_table(pairs.permuted_cells(df, weights, z, col_of(label), key, repeats, seed, score_digits))
    per = classification_metrics(cells.where("feature IS NOT NULL"), "label", "prediction", ["feature", "repeat"], "n").select("feature", "repeat", metric)
    baseline = classification_metrics(cells.where("feature IS NULL"), "label", "prediction", weight="n").select(metric).scalar()
    per = run_table(per)  # one row per feature and repeat; reports read it several times
    drops = per.select("feature", "repeat", (baseline - F.col(metric)).alias("drop"))
    return drops.groupBy("feature").agg(F.avg("drop").alias("importance_mean"),
                                        F.stddev_pop("drop").alias("importance_std"))


def combine_importance(coef: DataFrame, perm: DataFrame) -> DataFrame:
    """Coefficient and permutation importance joined on feature, each normalised by its
    maximum (W3)."""
    j = coef.join(perm, "feature", "inner")
    mc = j.agg(F.max(F.abs("coefficient"))).scalar()
    mp = j.agg(F.max("importance_mean")).scalar()
    return j.select("feature", "coefficient", "importance_mean",
                    F.try_divide(F.abs("coefficient"), mc).alias("coefficient_norm"),
                    F.try_divide(F.col("importance_mean"), mp).alias("permutation_norm"))
