"""Drift tests, p-value functions, quality checks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from veritab.functions.scalar import chi2_sf, ks_pvalue
from veritab.operators import drift as D
from veritab.operators import profile as P
from veritab.operators import quality as Q
from veritab.plans.monitor import tag_sides


def _sides(spark, a, b):
    ref = spark.createDataFrame([(float(x),) for x in a], "x double")
    cur = spark.createDataFrame([(float(x),) for x in b], "x double")
    return tag_sides(ref, cur)


def test_ks_of_table_with_itself_is_zero(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(0, 1, 300)
    r = D.ks_two_sample(_sides(spark, a, a), ["x"]).first()
    assert r["statistic"] == 0.0 and r["p_value"] == 1.0 and not r["drifted"]


def test_ks_statistic_brute_force(spark):
    rng = np.random.default_rng(1)
    a, b = np.round(rng.normal(0, 1, 400), 1), np.round(rng.normal(0.3, 1, 300), 1)
    r = D.ks_wasserstein(_sides(spark, a, b), ["x"]).first()
    grid = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    assert r["statistic"] == pytest.approx(np.abs(fa - fb).max(), abs=1e-12)
    w1 = (np.abs(fa - fb)[:-1] * np.diff(grid)).sum()
    assert r["wasserstein"] == pytest.approx(w1, abs=1e-12)
    assert r["drifted"]


def _eval(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_ks_pvalue_known_values(spark):
    # Kolmogorov distribution: P(K > 1.36) ~ 0.049, P(K > 1.0) ~ 0.27
    # lambda = D * sqrt(n m / (n + m)) with n = m = 1e8, so D = lambda / sqrt(5e7)
    assert _eval(spark, ks_pvalue(F.lit(1.36 / math.sqrt(5e7)), F.lit(10 ** 8), F.lit(10 ** 8))) == pytest.approx(0.0494, abs=1e-3)
    assert _eval(spark, ks_pvalue(F.lit(1.0 / math.sqrt(5e7)), F.lit(10 ** 8), F.lit(10 ** 8))) == pytest.approx(0.2700, abs=1e-3)


def test_chi2_sf_known_values(spark):
    # chi2 survival: df=1, x=3.841 -> 0.05; df=4, x=9.488 -> 0.05; df=3, x=0 -> 1
    assert _eval(spark, chi2_sf(F.lit(3.841458820694124), F.lit(1))) == pytest.approx(0.05, abs=1e-9)
    assert _eval(spark, chi2_sf(F.lit(9.487729036781154), F.lit(4))) == pytest.approx(0.05, abs=1e-9)
    assert _eval(spark, chi2_sf(F.lit(0.0), F.lit(3))) == 1.0


def test_psi_nonnegative_and_zero_on_same(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(0, 1, 500)
    same = D.psi_kl(_sides(spark, a, a), ["x"]).first()
    assert same["psi"] == pytest.approx(0.0, abs=1e-12)
    b = rng.normal(1, 1, 500)
    r = D.psi_kl(_sides(spark, a, b), ["x"]).first()
    assert r["psi"] > 0.25 and r["kl_divergence"] > 0


def test_chi_square_drift(spark):
    ref = spark.createDataFrame([("a",)] * 50 + [("b",)] * 50, "c string")
    cur = spark.createDataFrame([("a",)] * 80 + [("b",)] * 20, "c string")
    r = D.chi_square(tag_sides(ref, cur), ["c"]).first()
    # 2x2 table: chi2 = 200 * (50*20 - 50*80)^2 / (100*100*130*70)
    assert r["statistic"] == pytest.approx(200 * (50 * 20 - 50 * 80) ** 2 / (100 * 100 * 130 * 70))
    assert r["dof"] == 1 and r["drifted"]


def test_cv_drift_rule(spark):
    ref = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    cur = spark.createDataFrame([(1.0,), (5.0,), (9.0,)], "x double")
    rows = {(r["side"], r["feature"], r["metric"]): r["value"]
            for r in D.cv_drift(tag_sides(ref, cur), ["x"]).collect()}
    cvr, cvc = 1.0 / 2.0, 4.0 / 5.0
    assert rows[("both", "x", "drift_score")] == pytest.approx(min(1.0, abs(cvc - cvr) / cvr))


def test_nan_becomes_null_in_sources(spark, tmp_path):
    from veritab.sources.io import read_table
    p = str(tmp_path / "nan.parquet")
    spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double").write.parquet(p)
    df = read_table(spark, p)
    assert df.where(F.col("x").isNull()).count() == 1
    assert df.agg(F.avg("x")).first()[0] == 2.0


def test_quality_percent_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3.0), (3, 4.0)], "a int, b double")
    d = P.duplicate_rows(df).first()
    assert d["duplicates"] == 1 and d["percent"] == 25.0
    q = {r["metric"]: r for r in Q.quality_percent(df).collect()}
    assert q["missing_percentage"]["value"] == pytest.approx(2 / 8 * 100)
    assert q["quality_score"]["value"] == 75.0 and q["quality_score"]["status"] == "warning"


def test_stability(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1), (2.0, 0), (2.0, 0)], "x double, y int")
    r = Q.stability(df, ["x"], "y").first()
    assert r["unstable_rows"] == 2 and r["share"] == 0.5


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(21)], "x double")
    h = {r["bin"]: r["n"] for r in P.histogram(df, "x", bins=20).collect()}
    assert len(h) == 20 and h[19] == 2 and sum(h.values()) == 21


def test_describe_matches_numpy(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(5, 2, 333)
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    d = P.describe(df, ["x"]).first()
    assert d["std"] == pytest.approx(np.std(v, ddof=1))
    assert d["q25"] == pytest.approx(np.quantile(v, 0.25)) and d["q75"] == pytest.approx(np.quantile(v, 0.75))


def test_zero_divisors_do_not_raise_under_ansi(spark):
    # Spark 4 runs ANSI mode: x / 0 raises; operators must return null instead
    ref = spark.createDataFrame([(0.0, "a"), (0.0, "a")], "x double, c string")
    cur = spark.createDataFrame([(1.0, "b"), (-1.0, "b")], "x double, c string")
    t = tag_sides(ref, cur)
    assert D.cv_drift(t, ["x"]).count() == 5
    assert D.cv_score(ref, ["x"]).first()["cv"] is None
    assert P.coefficient_of_variation(cur, ["x"]).first()["cv"] is None
    assert D.psi_kl(t, ["x"]).first()["psi"] > 0
