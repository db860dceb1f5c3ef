import numpy as np
import pytest

from veritab.operators import permute as P

SCHEMA = "id long, x array<double>, label int"


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutations_are_bijections_and_differ(n):
    ranks = np.arange(n)
    images = [P.permuted(ranks, n, P.job_key(j, r, 42)) for j in range(3) for r in range(3)]
    assert all(np.array_equal(np.sort(i), ranks) for i in images)
    assert np.array_equal(P.permuted(ranks[::-1], n, P.job_key(0, 0, 42))[::-1], images[0])  # of a rank alone
    if n >= 17:
        assert len({tuple(i) for i in images}) == 9
        assert abs(np.corrcoef(ranks, images[0])[0, 1]) < 0.6


def test_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x, w, bias = rng.normal(size=(120, 3)), np.array([2.0, -1.0, 0.0]), 0.1
    y = (x @ w + bias + rng.normal(size=120) > 0).astype(int)
    df = spark.createDataFrame([(i, [float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y))], SCHEMA)
    held = {}
    real = P.run_table

    def keep(frame):
        held["table"] = real(frame)
        return held["table"]

    monkeypatch.setattr(P, "run_table", keep)
    monkeypatch.setattr(P, "BLOCK_VALUES", 200)  # several blocks
    monkeypatch.setattr(P, "CHUNK", 50)
    got = {r.feature_index: (r.importance_mean, r.importance_std) for r in P.importance(df.repartition(3), "x", "id", w, bias, [0, 1, 2], 4).collect()}
    rows = sorted(held["table"].collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == list(range(120))
    xs, ys = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows])
    recall = lambda m: ((m @ w + bias >= 0) & (ys > 0)).sum() / (ys > 0).sum()
    for j in range(3):
        drops = []
        for r in range(4):
            swapped = xs.copy()
            swapped[P.permuted(np.arange(120), 120, P.job_key(j, r, 42)), j] = xs[:, j]
            drops.append(recall(xs) - recall(swapped))
        assert np.allclose(got[j], (np.mean(drops), np.std(drops)), atol=1e-12)
    assert got[0][0] > got[1][0] > got[2][0] == 0


def test_odd_tables(spark):
    odd = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, None, 1), (3, [None, 1.0], 0), (4, [1.0, 1.0], None)], SCHEMA)
    assert {tuple(r) for r in P.importance(odd, "x", "id", [1.0, 1.0], 0.0, [0, 1]).collect()} == {(0, 0.0, 0.0), (1, 0.0, 0.0)}
    assert P.importance(odd.limit(0), "x", "id", [1.0, 1.0], 0.0, [0]).first().importance_mean == 0
    assert P.importance(odd, "x", "id", [1.0, 1.0], 0.0, []).count() == 0


def test_blocks_scored_in_parts_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, [float(v) for v in x], int(x[0] > 0)) for i, x in enumerate(rng.normal(size=(80, 2)))], SCHEMA)
    whole = sorted(P.importance(df, "x", "id", [1.0, 0.5], 0.0, [0, 1], 3).collect())
    monkeypatch.setattr(P, "SCORED", 7)
    assert sorted(P.importance(df, "x", "id", [1.0, 0.5], 0.0, [0, 1], 3).collect()) == whole
    assert P.BLOCK_VALUES <= 500_000  # a task holds some fifteen numbers for each of them
