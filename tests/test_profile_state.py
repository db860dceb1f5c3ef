import numpy as np
import pytest
from pyspark.sql import functions as F

from veritab.operators import profile as P
from veritab.operators import profile_state as S

DAYS = 7


@pytest.fixture(scope="module")
def rows(spark):
    """A hot day, a large mean, ties, nulls, NaN, a column without values and one that does not vary."""
    i = F.col("id")
    day = F.when(i % 3 == 0, 0).otherwise(i % DAYS).cast("int")
    return (spark.range(30_000, numPartitions=6).select(
        day.alias("day"), (F.xxhash64("id") % 1000003 / 7.0 + 1e6).alias("a b"),
        F.when(i % 5 == 0, F.lit(float("nan"))).when(i % 11 != 0, (F.xxhash64(i, F.lit(1)) % 50).cast("double")).alias("x"),
        F.lit(2.5).alias("same"), F.lit(None).cast("double").alias("none"),
        F.when(i % 13 != 0, F.concat(F.lit("v"), (F.sqrt(i % 900)).cast("int"))).alias("c")))


NUMERIC = ["a b", "x", "same", "none"]


def _clean(rows):
    return rows.withColumns({"x": F.when(~F.isnan("x"), F.col("x"))})


def _by_feature(df):
    return {r.feature: r for r in df.collect()}


@pytest.fixture(scope="module")
def states(rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("states"))
    S.save_states(S.column_states(rows, NUMERIC, ["c"], ["day"]), path, ["day"])
    return path


def test_merge_of_days_is_the_profile_of_the_rows(spark, rows, states):
    got = _by_feature(S.profile_of(S.merge_states(S.load_states(spark, states))))
    want = _by_feature(P.column_profile(_clean(rows), NUMERIC, ["c"]))
    assert set(got) == {*NUMERIC, "c"}
    for f, w in want.items():
        g = got[f]
        assert (g["count"], g.missing) == (w["count"], w.missing)
        for k in ("mean", "std", "min", "max"):
            assert g[k] is None and w[k] is None or np.isclose(g[k], w[k], rtol=1e-11, atol=1e-12)
        assert abs(g.distinct - w.distinct) <= 6 * g.distinct_error
        if g.mode_error == 0:
            assert (g.mode_text, g.mode_num) == (w.mode_text, w.mode_num)
    assert got["a b"].mode_error > 0 and got["x"].mode_error == 0 and got["x"].distinct == 99 and got["c"].mode_count > 1


def test_quantiles_keep_their_rank_bound(spark, rows, states):
    got = _by_feature(S.profile_of(S.merge_states(S.load_states(spark, states))))
    for f in ("a b", "x", "same"):
        v = np.sort(np.array([r[0] for r in _clean(rows).select(F.col(f"`{f}`")).collect() if r[0] is not None]))
        for p, q in ((0.25, got[f].q25), (0.5, got[f].q50), (0.75, got[f].q75)):
            below, upto = np.searchsorted(v, q) / len(v), np.searchsorted(v, q, side="right") / len(v)
            # the bound is kept with probability 0.99; 2.5 times it fails once in 10^9
            assert below - 2.5 * got[f].rank_error <= p <= upto + 2.5 * got[f].rank_error
    assert got["none"].q50 is None and got["c"].q50 is None


def test_merging_is_associative_and_keeps_groups(spark, states):
    s = S.load_states(spark, states).withColumn("half", F.col("day") < 3)
    once = _by_feature(S.profile_of(S.merge_states(s)))
    twice = _by_feature(S.profile_of(S.merge_states(S.merge_states(s, ["half"]))))
    for f, g in once.items():
        t = twice[f]
        assert (g["count"], g.missing, g.distinct, g.min, g.max) == (t["count"], t.missing, t.distinct, t.min, t.max)
        assert g.std is None and t.std is None or np.isclose(g.std, t.std, rtol=1e-11)
    assert S.merge_states(s, ["half"]).count() == 2 * len(once)


def test_a_range_reads_its_days_only(spark, rows, states):
    picked = S.profile_of(S.merge_states(S.load_states(spark, states, F.col("day").between(2, 4))))
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "Range (" not in plan and "PartitionFilters: [isnotnull(day" in plan
    want = rows.where("day between 2 and 4")
    assert {r["count"] + r.missing for r in picked.collect()} == {want.count()}


def test_repeated_day_replaces_its_states(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    S.save_states(S.column_states(rows, ["x"], [], ["day"]), path, ["day"])
    for _ in range(2):
        S.save_states(S.column_states(rows.where("day = 1").limit(10), ["x"], [], ["day"]), path, ["day"])
    got = {r.day: r.n_rows for r in S.load_states(spark, path).collect()}
    want = {r.day: r["count"] for r in rows.groupBy("day").count().collect()}
    assert got == want | {1: 10}


def test_correlation_from_co_moments(rows):
    cols = ["a b", "x", "same", "none"]
    pairs = S.merge_pairs(S.pair_states(rows, cols, ["day"]))
    got = {(r.feature_a, r.feature_b): r["corr"] for r in S.correlations_of(pairs).collect()}
    want = {(r.feature_a, r.feature_b): r["corr"] for r in P.correlation_matrix(_clean(rows), cols).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k] is None and w is None or np.isclose(got[k], w, atol=1e-9), k


def test_pairs_in_several_scans(rows, monkeypatch):
    one = {tuple(r) for r in S.pair_states(rows, ["a b", "x", "same"], ["day"]).select("day", "feature_a", "feature_b", "count").collect()}
    monkeypatch.setattr(S, "PAIRS", 4)
    assert one == {tuple(r) for r in S.pair_states(rows, ["a b", "x", "same"], ["day"]).select("day", "feature_a", "feature_b", "count").collect()}


def test_empty_table_and_null_partition(spark, rows):
    assert S.profile_of(S.merge_states(S.column_states(rows.limit(0), ["x"], ["c"], ["day"]))).count() == 0
    none = rows.withColumn("day", F.when(F.col("day") > 0, F.col("day")))
    s = S.merge_states(S.column_states(none, ["x"], ["c"], ["day"]), ["day"])
    want = {r.day: r["count"] for r in none.groupBy("day").count().collect()}
    assert None in want and {r.day: r.n_rows for r in s.collect()} == want
    pairs = S.pair_states(none, ["x", "same"], ["day"])
    assert S.merge_pairs(pairs, ["day"]).count() == pairs.count() == 3 * len(want)
