import threading

import numpy as np
import pyarrow as pa
import pytest

from pyspark.ml.functions import vector_to_array

from veritab.operators import boosting as B
from veritab.operators import models as M

SCHEMA = "id long, x array<double>, label int"


def _frame(spark, x, y, parts=3):
    rows = [(i, [None if np.isnan(v) else float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def _table(n=300, d=5, seed=1, lost=0.1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, d)), 1)
    y = (x[:, 0] + np.where(np.isnan(x[:, 1]), 0, x[:, 1]) * x[:, 2] + 0.3 * rng.normal(size=n) > 0).astype(int)
    x[rng.random((n, d)) < lost] = np.nan
    return x, y


def _best(x, g, h, l2, min_child):
    """Best cut of the rows by trying every value of every feature, missing rows on either side."""
    found = None
    score = lambda a, b: a * a / (b + l2)
    for f in range(x.shape[1]):
        for v in np.unique(x[~np.isnan(x[:, f]), f]):
            for missing_left in (False, True):
                left = np.where(np.isnan(x[:, f]), missing_left, x[:, f] <= v)
                gl, hl = g[left].sum(), h[left].sum()
                gr, hr = g[~left].sum(), h[~left].sum()
                if min(hl, hr) < min_child or min(hl, hr) <= 0:
                    continue
                gain = score(gl, hl) + score(gr, hr) - score(gl + gr, hl + hr)
                if found is None or gain > found[0] + 1e-7:
                    found = (gain, f, v, missing_left, left)
    return found if found and found[0] > 1e-7 else None


def _brute(x, y, rounds, depth, rate, pos_weight, l2=1.0, min_child=1.0):
    margin = np.zeros(len(y))
    w = np.where(y > 0, pos_weight, 1.0)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        new = np.zeros(len(y))

        def grow(rows, level):
            cut = _best(x[rows], g[rows], h[rows], l2, min_child) if level < depth else None
            if cut is None:
                new[rows] = -rate * g[rows].sum() / (h[rows].sum() + l2)
                return
            grow(rows[cut[4]], level + 1)
            grow(rows[~cut[4]], level + 1)

        grow(np.arange(len(y)), 0)
        margin += new
    return 1 / (1 + np.exp(-margin))


def _probabilities(model, df):
    got = model.transform(df).select("id", vector_to_array("probability")[1].alias("p")).orderBy("id").collect()
    return np.array([r["p"] for r in got])


def _loss(p, y, pos_weight):
    w = np.where(y > 0, pos_weight, 1.0)
    return -(w * np.where(y > 0, np.log(p), np.log(1 - p))).mean()


def _whole(**more):
    return B.BoostedTrees("x", ("id",), **{"subsample": 1.0, "col_sample": 1.0, **more})


def test_first_cut_by_hand(spark):
    # margins 0: g = 1/2 - y, h = 1/4; cut after 2: GL = 1, HL = 1/2
    df = _frame(spark, np.array([[1.0], [2.0], [3.0], [4.0]]), [0, 0, 1, 1])
    t = _whole(rounds=1, max_depth=1, min_child=0.0, pos_weight=1.0).fit(df).trees[0]
    assert (t.feature[0], t.cut[0]) == (0, 2.0)
    assert np.isclose(t.gain[0], 2 * 1 / 1.5)
    assert np.allclose(t.value[1:], [-0.1 / 1.5, 0.1 / 1.5])


def test_positive_weight_by_hand(spark):
    df = _frame(spark, np.array([[1.0], [1.0], [2.0]]), [0, 0, 1])
    t = _whole(rounds=1, max_depth=1, min_child=0.0, pos_weight=2.0).fit(df).trees[0]
    # left: g = 1, h = 1/2; right: g = -2 * 1/2, h = 2 * 1/4
    assert np.allclose(t.value[1:], [-0.1 / 1.5, 0.1 / 1.5]) and np.isclose(t.gain[0], 2 / 1.5)


def test_missing_values_take_the_better_side(spark):
    nan = np.nan
    x = np.array([[1.0], [1.0], [2.0], [2.0], [nan], [nan]])
    left = _whole(rounds=1, max_depth=1, min_child=0.0).fit(_frame(spark, x, [1, 1, 0, 0, 1, 1])).trees[0]
    right = _whole(rounds=1, max_depth=1, min_child=0.0).fit(_frame(spark, x, [1, 1, 0, 0, 0, 0])).trees[0]
    assert left.missing_left[0] and not right.missing_left[0]
    # only being missing tells the classes apart
    only = _whole(rounds=1, max_depth=1, min_child=0.0).fit(_frame(spark, x, [0, 0, 0, 0, 1, 1])).trees[0]
    assert not only.missing_left[0] and only.value[2] > 0 > only.value[1]


def test_equals_brute_force_and_loss_falls(spark):
    x, y = _table()
    df = _frame(spark, x, y)
    model = _whole(rounds=12, max_depth=3).fit(df)  # past one writing of the margins
    p = _probabilities(model, df)
    assert np.allclose(p, _brute(x, y, 12, 3, 0.1, 1.7), atol=1e-6)
    losses = [_loss(_probabilities(B.BoostedModel(model.trees[:k], "x", 5), df), y, 1.7) for k in (0, 1, 4, 8, 12)]
    assert all(a > b for a, b in zip(losses, losses[1:]))


@pytest.mark.parametrize("cells", [B.CELLS, 1])
def test_trees_do_not_depend_on_partitions_or_scans(spark, monkeypatch, cells):
    x, y = _table(200, 4, 3)
    make = B.BoostedTrees("x", ("id",), rounds=3, max_depth=3)
    one = make.fit(_frame(spark, x, y, 1))
    monkeypatch.setattr(B, "CELLS", cells)
    monkeypatch.setattr(B, "TASK_ROWS", 40)
    many = make.fit(_frame(spark, x, y, 7))
    for a, b in zip(one.trees, many.trees):
        assert all(np.array_equal(p, q) for p, q in zip(a, b))


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = _whole(rounds=2).fit(empty)
    assert model.trees == []
    odd = spark.createDataFrame([(1, [1.0, float("nan")], 1), (2, None, 0), (3, [2.0, None], None), (4, [], 0), (5, [3.0, 1.0], 0)], SCHEMA)
    assert np.allclose(_probabilities(model, odd), 0.5)
    fitted = _whole(rounds=2, max_depth=2, min_child=0.0).fit(odd)
    assert len(_probabilities(fitted, odd)) == 5
    # one class only: no cut gains, every row gets the same probability
    same = _whole(rounds=2).fit(_frame(spark, np.ones((5, 2)), [1] * 5))
    p = _probabilities(same, _frame(spark, np.ones((3, 2)), [1] * 3))
    assert len(set(p)) == 1 and p[0] > 0.5


def test_scans_take_whole_pieces_and_read_them_in_place(monkeypatch):
    monkeypatch.setattr(B, "PIECE", 7)
    x = np.random.default_rng(0).integers(0, 256, (20, 5)).astype(np.uint8)
    batch = pa.record_batch([pa.array([r.tobytes() for r in x], pa.binary())], ["bins"])
    got = list(B._pieces(batch.slice(i, 3) for i in range(0, 20, 3)))
    assert [len(p) for p in got] == [7, 7, 6]
    assert np.array_equal(np.concatenate([B._bins_of(p) for p in got]), x)
    part = B._bins_of(batch.slice(4, 9))
    assert np.array_equal(part, x[4:13]) and np.shares_memory(part, np.frombuffer(batch.column("bins").buffers()[2], np.uint8))


def test_fits_of_a_comparison_run_at_once(spark):
    four = threading.Barrier(4)
    assert len(M.each(lambda i: four.wait(60), range(4), spark.range(1))) == 4
