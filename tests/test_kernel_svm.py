import numpy as np
import pytest

from veritab.operators import kernel_svm as K

SCHEMA = "id long, x array<double>, label int, weight double"


def _rows(n, seed=2):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 2)
    y = ((x ** 2).sum(1) + 0.5 * rng.normal(size=n) > 2.5).astype(int)
    return x, y, np.where(y > 0, 1.5, 0.75)


def _frame(spark, x, y, w, parts=3):
    rows = [(i, [float(v) for v in r], int(t), float(c)) for i, (r, t, c) in enumerate(zip(x, y, w))]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def _dual(x, y, c, gamma, tol=1e-7):
    """Margins by pairwise steps on the full kernel: always the pair that violates most."""
    t = np.where(y > 0, 1.0, -1.0)
    k = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(2))
    a, g = np.zeros(len(t)), -np.ones(len(t))
    for _ in range(200_000):
        up, low = np.where(t > 0, a < c, a > 0), np.where(t > 0, a > 0, a < c)
        v = -t * g
        i, j = np.argmax(np.where(up, v, -np.inf)), np.argmin(np.where(low, v, np.inf))
        if v[i] - v[j] < tol:
            break
        step = (v[i] - v[j]) / max(k[i, i] + k[j, j] - 2 * k[i, j], 1e-12)
        step = min(step, c[i] - a[i] if t[i] > 0 else a[i], a[j] if t[j] > 0 else c[j] - a[j])
        a[i] += t[i] * step
        a[j] -= t[j] * step
        g += step * t * (k[:, i] - k[:, j])
    b = (v[i] + v[j]) / 2
    return k @ (a * t) + b, a.sum() - (a * t) @ k @ (a * t) / 2


def test_margins_equal_the_dual_on_200_rows(spark):
    x, y, w = _rows(200)
    df = _frame(spark, x, y, w)
    model = K.KernelSVM("x", ("id",), gamma=0.4, tolerance=1e-9).fit(df)
    want, best = _dual(x, y, w, 0.4)
    got = np.array([r.margin for r in model.transform(df).orderBy("id").collect()])
    assert np.allclose(got, want, atol=2e-3)
    assert 0 <= model.gap <= 1e-8 * model.objective + 1e-9 and np.isclose(model.objective, best, rtol=1e-6)
    assert abs(model.kernel_residual) < 1e-6 and 0 < model.support <= 200


def test_few_landmarks_report_what_they_miss(spark):
    x, y, w = _rows(300, 4)
    df = _frame(spark, x, y, w)
    few, more = (K.KernelSVM("x", ("id",), gamma=0.4, landmarks=m).fit(df) for m in (10, 80))
    assert 1 > few.kernel_residual > more.kernel_residual > 0
    assert all(0 <= m.gap <= 1e-6 * m.objective for m in (few, more))


def test_default_gamma_and_odd_rows(spark):
    x, y, w = _rows(60, 6)
    x[1] = x[0]  # repeated rows are one landmark
    odd = spark.createDataFrame([(100, None, 1, 1.0), (101, [1.0, None, 2.0], 0, 1.0), (102, [float("nan")] * 3, 1, 1.0), (103, [0.0] * 3, None, 1.0)], SCHEMA)
    df = _frame(spark, x, y, w)
    model = K.KernelSVM("x", ("id",)).fit(df.unionByName(odd))
    assert np.isclose(model.phi.gamma, 1 / (3 * x.var())) and len(model.phi.landmarks) == 59
    got = {r.id: r.margin for r in model.transform(odd).collect()}
    assert got[100] is None and got[101] is None and got[102] is None and got[103] is not None


def test_one_class_and_empty(spark):
    x, _, w = _rows(8)
    model = K.KernelSVM("x", ("id",)).fit(_frame(spark, x, np.zeros(8), w))
    assert {r.margin for r in model.transform(_frame(spark, x, np.zeros(8), w)).collect()} == {-1.0}
    with pytest.raises(ValueError):
        K.KernelSVM("x", ("id",)).fit(spark.createDataFrame([], SCHEMA))
