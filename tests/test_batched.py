"""Many logistic fits in one pass: equal to single Spark ML fits and to the optimality conditions."""
import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from veritab.operators import batched as B
from veritab.operators import models as M


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 5))
    y = (x @ [1.0, -2.0, 0.5, 0.0, 0.0] + rng.normal(size=400) > 0.7).astype(int)
    rows = [(i, x[i].tolist(), int(y[i]), int(i % 4)) for i in range(400)]
    return spark.createDataFrame(rows, "k long, x array<double>, label int, fold int")


def spark_fit(df, fit):
    part = df if fit.fold is None else df.where(F.col("fold") != fit.fold)
    if fit.fraction < 1:
        from veritab.functions.scalar import uniform_hash
        part = part.where(uniform_hash("k", seed=42) < fit.fraction)
    keep = [j for j in range(5) if j not in fit.without]
    part = part.withColumn("features", array_to_vector(F.array(*[F.col("x")[j] for j in keep])))
    if fit.balanced:
        part = M.balanced_weights(part, "label", "weight")
    else:
        part = part.withColumn("weight", F.lit(1.0))
    model = LogisticRegression(regParam=fit.lam, elasticNetParam=fit.alpha, standardization=False, weightCol="weight",
                               tol=1e-14, maxIter=3000).fit(part)
    out = np.zeros(6)
    out[0] = model.intercept
    out[[j + 1 for j in keep]] = model.coefficients.toArray()
    return out


FITS = [B.Fit(0.01), B.Fit(0.1, fold=1), B.Fit(1e-4, fold=0, balanced=False), B.Fit(0.02, fold=2, fraction=0.5), B.Fit(0.01, without=(1, 3)),
        B.Fit(0.02, alpha=1.0, fold=3), B.Fit(0.05, alpha=0.5, balanced=False)]


def test_coefficients_equal_single_fits(table):
    beta, scans = B.fit_many(B.rows_of(table, "x", "k"), FITS)
    assert scans <= 40
    for fit, b in zip(FITS, beta):
        assert np.abs(b - spark_fit(table, fit)).max() < (1e-6 if not fit.alpha else 1e-5), fit


def test_optimality_conditions(table):
    """The gradient vanishes, or lies within the L1 bound where a coefficient is 0."""
    rows = table.collect()
    x, y, fold = np.array([[1.0, *r["x"]] for r in rows]), np.array([r["label"] for r in rows]), np.array([r["fold"] for r in rows])
    fits = [B.Fit(0.05, alpha=a, fold=1, balanced=False) for a in (0.0, 0.3, 1.0)]
    beta, _ = B.fit_many(B.rows_of(table, "x", "k"), fits)
    own = fold != 1
    for fit, b in zip(fits, beta):
        g = x[own].T @ (1 / (1 + np.exp(-x[own] @ b)) - y[own]) / own.sum()
        g[1:] += fit.lam * (1 - fit.alpha) * b[1:]
        bound = np.r_[0.0, np.full(5, fit.lam * fit.alpha)]
        assert np.abs(np.where(b == 0, np.maximum(np.abs(g) - bound, 0), g + bound * np.sign(b))).max() < 1e-8


def test_confusions_and_out_of_fold(table):
    rows = B.rows_of(table, "x", "k")
    fits = [B.Fit(0.01, fold=f) for f in range(4)]
    beta, _ = B.fit_many(rows, fits)
    found = B.confusions(rows, fits, beta)
    oof = B.out_of_fold(table, "x", {f: beta[f] for f in range(4)})
    for f in range(4):
        part = oof.where(F.col("fold") == f).collect()
        assert found[f, "validation"]["accuracy"] == pytest.approx(np.mean([r["label"] == r["prediction"] for r in part]))


def test_weights_come_from_the_own_rows_only(spark):
    """A left-out fold with all positives must not change the weights of the others."""
    rng = np.random.default_rng(1)
    rows = [(i, [float(rng.normal())], int(i % 3 == 0), 0) for i in range(90)] + [(90 + i, [9.0], 1, 1) for i in range(50)]
    df = spark.createDataFrame(rows, "k long, x array<double>, label int, fold int")
    with_, _ = B.fit_many(B.rows_of(df, "x", "k"), [B.Fit(0.1, fold=1)])
    alone, _ = B.fit_many(B.rows_of(df.where("fold = 0"), "x", "k"), [B.Fit(0.1)])
    assert np.allclose(with_, alone, atol=1e-9)


def test_odd_tables(spark):
    schema = "k long, x array<double>, label int, fold int"
    rows = [(1, [1.0], 1, 0), (2, [2.0], 1, 1), (3, None, 1, 0), (4, [None], 0, 0), (5, [float("nan")], 0, 0), (6, [1.0], None, 0)]
    beta, _ = B.fit_many(B.rows_of(spark.createDataFrame(rows, schema), "x", "k"), [B.Fit(0.1), B.Fit(0.1, fold=0)])
    assert (beta == [[1.0, 0.0]] * 2).all()
    beta, _ = B.fit_many(B.rows_of(spark.createDataFrame([], schema), "x", "k"), [B.Fit(0.1)])
    assert (beta == 0).all()


def test_separable_rows_end(spark):
    df = spark.createDataFrame([(i, [float(i)], int(i >= 10), i % 2) for i in range(20)], "k long, x array<double>, label int, fold int")
    beta, scans = B.fit_many(B.rows_of(df, "x", "k"), [B.Fit(1e-6), B.Fit(1e-8, alpha=1.0)])
    assert np.isfinite(beta).all() and scans <= B.MAX_SCANS + 1


def test_invalid_combinations_rank_last(table):
    out = M.random_search(table, "x", "k", {"C": (0.1, 1.0), "penalty": ("l2", "elasticnet"), "solver": ("liblinear", "saga"), "l1_ratio": (0.5,)}, 8, 300)
    rows = out.collect()
    bad = [r for r in rows if "elasticnet" in r["params"] and "liblinear" in r["params"]]
    assert len(rows) == 8 and len(bad) == 2 and all(r["recall_mean"] is None for r in bad)
    assert min(r["rank"] for r in bad) > max(r["rank"] for r in rows if r not in bad)
