import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from veritab.operators import evaluate as EV
from veritab.operators import pairs as P


def _brute(rows, features, repeats, seed=42):
    """(key, feature, repeat) -> (original, permuted) of rows of unique keys."""
    out = {}
    md5 = lambda *x: hashlib.md5("|".join(str(v) for v in x if v is not None).encode()).hexdigest()
    own = sorted(rows, key=lambda r: md5(r[0], r[1], seed))
    for i, f in enumerate(features):
        for n in range(repeats):
            src = sorted(rows, key=lambda r: md5(r[0], r[1], f, n, seed))
            for a, b in zip(own, src, strict=True):
                out[a[0], a[1], f, n] = (a[2 + i], b[2 + i])
    return out


def test_equals_brute_force_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_VALUES", 200)
    monkeypatch.setattr(P, "ROWS", 40)
    rows = [(i, i % 3, float(i % 7) if i % 11 else None, math.nan if i % 13 == 0 else i / 3) for i in range(150)]
    df = spark.createDataFrame(rows, "a long, b int, u double, v double").repartition(3)
    got = P.permutation_pairs(df, ["u", "v"], ["a", "b"], 3, carry=["u"]).collect()
    assert len(got) == 150 * 6
    want = _brute(rows, ["u", "v"], 3)
    for r in got:
        assert str((r.original, r.permuted)) == str(want[r.a, r.b, r.feature, r.repeat])


def test_null_and_repeated_keys_meet_as_in_a_join(spark):
    rows = [(1, 1.0), (1, 2.0), (2, 3.0), (None, 4.0)]
    got = P.permutation_pairs(spark.createDataFrame(rows, "k long, u double"), ["u"], ["k"], 2).collect()
    assert sorted((r.k, r.original) for r in got) == sorted([(1, 1.0), (1, 1.0), (1, 2.0), (1, 2.0), (2, 3.0)] * 2)
    assert P.permutation_pairs(spark.createDataFrame([], "k long, u double"), ["u"], ["k"], 2).count() == 0


def test_pairs_are_shuffled_packed(spark):
    """Rows are neither joined nor ranked by a window per (feature, repeat)."""
    df = spark.range(2_000).select("id", (F.col("id") % 5).cast("double").alias("u"), (F.col("id") % 2).cast("int").alias("label"))
    plan = EV.permutation_pairs(df, ["u"], ["id"], 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
    imp = EV.linear_permutation_importance(df, {"u": 1.0}, -2.0, "label", ["id"], 10).first()
    assert imp.feature == "u" and abs(imp.importance_mean) < 0.1


@pytest.mark.parametrize("values", [np.arange(50) / 100, np.arange(5_000) / 100, np.zeros(0)])
def test_hashes_and_values_are_packed_tight(values):
    r = np.random.default_rng(1)
    x = (r.choice(values, 60_000) if len(values) else values).view(np.int64)
    h = np.sort(r.integers(0, 1 << 64, len(x), dtype=np.uint64))
    assert np.array_equal(P._unpack(P._pack(x)), x) and np.array_equal(P._unpack_sorted(P._pack_sorted(h)), h)
    assert len(P._pack_sorted(h)) < 6.4 * len(h) + 50  # 8 bytes each before
    if len(values) == 50:
        assert len(P._pack(x)) < 0.8 * len(x)


def test_rounds_of_jobs_give_the_same_pairs(spark, monkeypatch):
    df = spark.range(300).select("id", (F.col("id") % 7).cast("double").alias("u"), (F.col("id") / 3).alias("v"))
    whole = sorted(map(tuple, P.permutation_pairs(df, ["u", "v"], ["id"], 3).collect()))
    made = []
    keep = P.run_table
    monkeypatch.setattr(P, "run_table", lambda x: made.append(x.columns) or keep(x))
    monkeypatch.setattr(P, "ROUND", 600)
    assert sorted(map(tuple, P.permutation_pairs(df, ["u", "v"], ["id"], 3).collect())) == whole
    assert len([c for c in made if "vals" in c]) == 3  # two of six jobs at once
