"""Bootstrap by cells: draws, and metrics of every replicate against plain arithmetic on weighted rows."""
import hashlib
import math

import numpy as np
import pytest

from veritab.operators import resample as R


def table(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction int, score double")


@pytest.fixture(scope="module")
def scored():
    rng = np.random.default_rng(3)
    out = []
    for _ in range(600):
        s = round(float(rng.integers(0, 40)) / 40, 9)
        out.append((int(rng.random() < s), int(s >= 0.5), s))
    return out


def test_cdf_is_the_distribution_function():
    for n in (1, 7, 500, 100_000):
        low, cdf = R.poisson_cdf(n)
        k = np.arange(low, low + len(cdf))
        p = np.exp([i * math.log(n) - n - math.lgamma(i + 1) for i in k])
        assert np.allclose(cdf, np.cumsum(p), atol=1e-9) and abs(cdf[-1] - 1) < 1e-8
        mean = low + np.sum(1 - cdf)
        assert abs(mean - n) < 1e-3 * max(1, n ** 0.5)


def test_draws_follow_the_rule():
    one = np.array([1]), np.array([0]), np.array([250]), np.array([3])
    got = R.draws(*one, 0, 9, 42)[0]
    low, cdf = R.poisson_cdf(3)
    for r in range(9):
        digest = hashlib.md5(f"1|0|250|{r // 4}|42".encode()).hexdigest()
        u = int(digest[8 * (r % 4):8 * (r % 4) + 8], 16) / 2 ** 32
        assert got[r] == low + int(np.sum(cdf <= u))
    assert (R.draws(*one, 4, 9, 42)[0] == got[4:]).all()


def brute(w, replicates):
    out = {}
    for r in range(replicates):
        rows = [(y, p, s, x) for (y, p, s), x in ((k, v[r]) for k, v in w.items()) if x]
        tp, fp, fn, tn = (sum(x for y, p, _, x in rows if (y, p) == c) for c in ((1, 1), (0, 1), (1, 0), (0, 0)))
        pos, neg = tp + fn, fp + tn
        u = sum(x * z * (1.0 if s > t else 0.5 if s == t else 0.0) for y, _, s, x in rows if y for q, _, t, z in rows if not q)
        ap = sum(x * sum(z for q, _, t, z in rows if q and t >= s) / sum(z for _, _, t, z in rows if t >= s) for y, _, s, x in rows if y)
        pr, rc = tp / (tp + fp) if tp + fp else 0.0, tp / (tp + fn) if tp + fn else 0.0
        out[r] = ((tp + tn) / (pos + neg), pr, rc, 2 * pr * rc / (pr + rc) if pr + rc else 0.0, u / (pos * neg), ap / pos)
    return out


@pytest.mark.parametrize("size", [20_000, 7])
def test_metrics_equal_brute_force(spark, scored, size, monkeypatch):
    monkeypatch.setattr(R, "RANGE", size)
    monkeypatch.setattr(R, "BLOCK", 4)
    df = table(spark, [*scored, (None, 1, 0.5), (1, None, 0.5), (1, 1, None)])
    many = 6
    w = {}
    for r in R.weights(R.cells(df, "label", "prediction", "score"), many).collect():
        w.setdefault((r["label"], r["prediction"], r["score"]), {})[r["replicate"]] = r["weight"]
    assert len(w) == len({x for x in scored})
    want = brute(w, many)
    got = R.replicate_metrics(df, "label", "prediction", "score", many).collect()
    assert len(got) == many
    for r in got:
        assert tuple(r)[1:] == pytest.approx(want[r["replicate"]], abs=1e-12)


def test_replicates_spread_like_resampled_rows(spark, scored):
    got = [r["accuracy"] for r in R.replicate_metrics(table(spark, scored), "label", "prediction", "score", 400).collect()]
    hit = np.mean([y == p for y, p, _ in scored])
    assert abs(np.mean(got) - hit) < 0.01
    assert np.std(got) == pytest.approx(math.sqrt(hit * (1 - hit) / len(scored)), rel=0.15)


def test_empty_and_one_class(spark):
    assert R.replicate_metrics(table(spark, []), "label", "prediction", "score", 3).collect() == []
    rows = R.replicate_metrics(table(spark, [(1, 1, 0.9)] * 50), "label", "prediction", "score", 3).collect()
    assert all(r["roc_auc"] is None and r["average_precision"] == 1.0 and r["recall"] == 1.0 for r in rows)
