"""Distributed running sums, exact quantiles and splits against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from veritab.operators.cumulative import exact_quantiles, running_sums
from veritab.operators import features as FE
from veritab.operators import profile as P


def test_running_sums_brute_force(spark):
    rng = np.random.default_rng(1)
    g = rng.integers(0, 3, 3000)
    v = rng.integers(0, 200, 3000).astype(float)  # heavy ties
    v[:1000] = 7.0  # one value holds a third of the rows
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, v)], "g int, v double")
    rs = running_sums(df, "v", {"n": F.lit(1)}, by=["g"], next_value=True).collect()
    for r in rs:
        sel = g == r["g"]
        assert r["cum_n"] == (v[sel] <= r["v"]).sum()
        assert r["tot_n"] == sel.sum()
        above = v[sel][v[sel] > r["v"]]
        assert r["next_value"] == (above.min() if len(above) else None)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(2)
    v = np.round(rng.exponential(3.0, 2500), 3)
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.975, 1.0)
    q = exact_quantiles(df, "v", probs, names=[f"p{i}" for i in range(len(probs))]).first()
    for i, p in enumerate(probs):
        assert q[f"p{i}"] == pytest.approx(np.quantile(v, p), abs=1e-9)


def test_exact_quantiles_skip_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (None,)], "v double")
    q = exact_quantiles(df, "v", (0.5,), names=["m"]).first()
    assert q["n"] == 2 and q["m"] == 2.0


def test_stratified_split_quota_and_balance(spark):
    rows = [(i, "A" if i % 3 else "B") for i in range(569)]
    df = spark.createDataFrame(rows, "k long, y string")
    s = FE.stratified_split(df, "y", ["k"], 0.2, 42)
    counts = {(r["split"], r["y"]): r["count"] for r in s.groupBy("split", "y").count().collect()}
    test_total = counts[("test", "A")] + counts[("test", "B")]
    assert test_total == int(np.ceil(569 * 0.2))
    assert sum(counts.values()) == 569
    # largest remainder: each class gets floor or ceil of its exact share
    for c, n in (("A", 379), ("B", 190)):
        exact = test_total * n / 569
        assert counts[("test", c)] in (int(np.floor(exact)), int(np.ceil(exact)))


def test_split_is_reproducible(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(300)], "k long, y int")
    a = {r["k"] for r in FE.stratified_split(df, "y", ["k"]).where("split = 'test'").collect()}
    b = {r["k"] for r in FE.stratified_split(df.repartition(7), "y", ["k"]).where("split = 'test'").collect()}
    assert a == b


def test_folds_balanced(spark):
    df = spark.createDataFrame([(i, i % 4 == 0) for i in range(1003)], "k long, y boolean")
    f = FE.stratified_folds(df, "y", ["k"], 5)
    per = f.groupBy("y", "fold").count().collect()
    for y in (True, False):
        cs = [r["count"] for r in per if r["y"] == y]
        assert len(cs) == 5 and max(cs) - min(cs) <= 1


def test_standard_scaling_moments(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(float(a), 5.0) for a in rng.normal(10, 3, 500)], "x double, c double")
    tr, te, _ = FE.standard_scale(df, df, ["x", "c"])
    r = tr.agg(F.avg("x"), F.stddev_pop("x"), F.max("c")).first()
    assert abs(r[0]) < 1e-9 and r[1] == pytest.approx(1.0) and r[2] == 0.0  # zero std divides by 1


def test_anova_f_matches_formula(spark):
    rng = np.random.default_rng(9)
    y = rng.integers(0, 3, 300)
    x = rng.normal(y * 0.5, 1.0)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, x)], "y int, x double")
    f = FE.anova_f(df, ["x"], "y").first()["f_stat"]
    groups = [x[y == k] for k in range(3)]
    m = x.mean()
    between = sum(len(g) * (g.mean() - m) ** 2 for g in groups) / 2
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(x) - 3)
    assert f == pytest.approx(between / within, rel=1e-9)


def test_ranks_of_a_long_table_by_ranges(spark):
    """Ties, nulls and a value that a third of the rows share; every range ranks its own rows."""
    df = spark.range(5_000, numPartitions=5).select(
        F.col("id").alias("a key"), F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 11 != 0, F.xxhash64("id") % 400).alias("v"))
    ranked = P.sort_desc(df, "v", "a key")
    want = sorted(df.collect(), key=lambda r: (r.v is None, -(r.v or 0), r[0]))
    assert [(r["rank"], r[0], r.v) for r in ranked.collect()] == [(i + 1, r[0], r.v) for i, r in enumerate(want)]
    assert P.sort_desc(df.limit(0), "v", "a key").collect() == []
