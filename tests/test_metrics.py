"""Golden arithmetic and properties of the evaluation operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from veritab.operators import evaluate as EV


def _cells(spark, tn, fp, fn, tp):
    rows = [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * tp
    return spark.createDataFrame(rows, "label int, prediction int")


def test_golden_confusion_cells(spark):
    # logistic model cells from the monitored project's results: 71/1/1/41
    m = EV.classification_metrics(_cells(spark, 71, 1, 1, 41), "label", "prediction").first()
    assert m["accuracy"] == pytest.approx(112 / 114)
    assert round(m["accuracy"], 5) == 0.98246
    assert round(m["recall"], 5) == 0.97619
    assert m["precision"] == pytest.approx(41 / 42)


def test_undefined_metrics_are_zero(spark):
    m = EV.classification_metrics(_cells(spark, 10, 0, 0, 0), "label", "prediction").first()
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1"] == 0.0


def test_confusion_keeps_zero_cells(spark):
    c = EV.confusion(_cells(spark, 5, 0, 0, 3), "label", "prediction").collect()
    assert {(r["actual"], r["predicted"]): r["n"] for r in c} == {(0, 0): 5, (0, 1): 0, (1, 0): 0, (1, 1): 3}


def _scores(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    s = np.round(rng.normal(y * 0.8, 1.0), 2)  # rounded: many ties
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double"), y, s


def _auc_brute(y, s):
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def _ap_brute(y, s):
    order = np.unique(s)[::-1]
    P = (y == 1).sum()
    ap, prev_r = 0.0, 0.0
    for t in order:
        sel = s >= t
        tp = (sel & (y == 1)).sum()
        r, p = tp / P, tp / sel.sum()
        ap += (r - prev_r) * p
        prev_r = r
    return ap


def test_auc_and_ap_match_brute_force(spark):
    df, y, s = _scores(spark)
    r = EV.ranking_metrics(df, "label", "score").first()
    assert r["roc_auc"] == pytest.approx(_auc_brute(y, s), abs=1e-12)
    assert r["average_precision"] == pytest.approx(_ap_brute(y, s), abs=1e-12)


def test_auc_of_negated_score(spark):
    df, y, s = _scores(spark)
    a = EV.roc_auc(df, "label", "score").first()[0]
    b = EV.roc_auc(df.withColumn("score", -F.col("score")), "label", "score").first()[0]
    assert a + b == pytest.approx(1.0, abs=1e-12)


def test_weighted_auc_equals_repeated_rows(spark):
    df, y, s = _scores(spark, 200)
    w = df.withColumn("w", (F.pmod((F.col("score") * 100).cast("int"), F.lit(3)) + 1).cast("int"))
    rep = w.select("label", "score", F.explode(F.sequence(F.lit(1), F.col("w"))).alias("_"))
    a = EV.roc_auc(w, "label", "score", weight="w").first()[0]
    b = EV.roc_auc(rep, "label", "score").first()[0]
    assert a == pytest.approx(b, abs=1e-12)


def test_bootstrap_summary_contains_mean(spark):
    df, y, s = _scores(spark, 300)
    df = df.withColumn("k", F.monotonically_increasing_id()).withColumn("prediction", (F.col("score") > 0.4).cast("int"))
    long = EV.bootstrap_metrics(df, "label", "prediction", "score", replicates=30)
    summ = {r["metric"]: r for r in EV.bootstrap_summary(long).collect()}
    assert set(summ) == {"accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"}
    for r in summ.values():
        assert r["ci95_low"] <= r["mean"] <= r["ci95_high"]
