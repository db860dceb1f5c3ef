import numpy as np
import pandas as pd

from veritab.operators import comoments as C
from veritab.operators import profile as P


def _wide(n, d, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 5))
    x = base @ rng.normal(size=(5, d)) + rng.normal(size=(n, d))
    x[:, 1] += 1e6  # a large mean
    x[:, 2] = 0.1  # does not vary
    x[:, 3] = np.where(np.arange(n) < n // 2, np.nan, 1 / 3)
    x[rng.random((n, d)) < 0.2] = np.nan
    x[:, 4] = np.nan
    x[1:, 5] = np.nan  # one value
    return pd.DataFrame(x, columns=[f"c {i}" for i in range(d)])


def _frame(spark, pdf, parts):
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in pdf.to_numpy()]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in pdf.columns)).repartition(parts)


def _as_matrix(rows, cols):
    got = {(r.feature_a, r.feature_b): r["corr"] for r in rows}
    assert len(rows) == len(got) == len(cols) ** 2
    return np.array([[np.nan if got[a, b] is None else got[a, b] for b in cols] for a in cols])


def test_equals_pairwise_complete_correlations(spark, monkeypatch):
    pdf = _wide(300, 150)
    cols = list(pdf.columns)
    want = pdf.corr().to_numpy()
    flat = [2, 3, 4, 5]
    want[flat, :], want[:, flat] = np.nan, np.nan
    df = _frame(spark, pdf, 5)
    matrix = P.correlation_matrix(df, cols)
    assert "corr(" not in matrix._jdf.queryExecution().executedPlan().toString()
    got = _as_matrix(matrix.collect(), cols)
    assert np.array_equal(np.isnan(got), np.isnan(want)) and np.allclose(got, want, atol=1e-9, equal_nan=True)
    strong = {(r.feature_a, r.feature_b) for r in P.strong_pairs(matrix, cols).collect()}
    assert strong == {(a, b) for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j and abs(got[i, j]) > 0.7}
    # several scans, as for thousands of columns
    monkeypatch.setattr(C, "PAIRS", 2)
    assert np.allclose(_as_matrix(C.correlations(df, cols).collect(), cols), want, atol=1e-9, equal_nan=True)


def test_blocks_equal_aggregates_on_few_columns(spark):
    pdf = _wide(80, 12, 8).drop(columns=["c 4"])
    cols = list(pdf.columns)
    df = _frame(spark, pdf, 3)
    aggregates, blocks = (_as_matrix(f(df, cols).collect(), cols) for f in (P.correlation_matrix, C.correlations))
    assert np.allclose(aggregates, blocks, atol=1e-9, equal_nan=True) and (~np.isnan(blocks)).sum() >= 64


def test_target_that_meets_a_constant_column(spark):
    df = spark.createDataFrame([(1.0, 3.0, 0), (1.0, 5.0, 1), (1.0, None, 1)], "a double, b double, y int")
    got = {r.feature: r["corr"] for r in P.target_correlation(df, ["a", "b"], df["y"]).collect()}
    assert got["a"] is None and np.isclose(got["b"], 1.0)


def test_empty_tables(spark):
    cols = [f"c{i}" for i in range(30)]
    empty = spark.createDataFrame([], ", ".join(f"{c} double" for c in cols))
    assert C.correlations(empty, []).count() == 0
    assert all(r["corr"] is None for r in P.correlation_matrix(empty, cols).collect())
