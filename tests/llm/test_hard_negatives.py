import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veritab.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=10):
    use = sorted({(i, t, tuple(int(np.floor(256 * float(x))) for x in v)) for i, v, t in rows
                  if i is not None and t is not None and v is not None
                  and all(x is not None and np.isfinite(x) for x in v)}, key=lambda x: x[:2])
    anchors = {}
    for r in use:
        if r[0] % 100 == 0:
            anchors.setdefault(r[0], r)
    out = []
    for a in anchors.values():
        scored = {(-sum(x * y for x, y in zip(a[2], v)), i, t == a[1]) for i, t, v in use if i != a[0]}
        for p, i, _ in sorted(x for x in scored if x[2])[:positives]:
            inside = [x for x in sorted(scored) if not x[2] and 30 * -p <= 100 * -x[0] <= 90 * -p]
            best = sorted({x[:2] for x in inside})[:negatives]
            out += [(a[0], i, k + 1, j, -p, -s) for k, (s, j) in enumerate(best)]
    return sorted(out)


def mined(spark, rows, **kw):
    use = hn.usable(spark.createDataFrame(rows, SCHEMA))
    return sorted(tuple(r) for r in hn.mine(use, use.where("id % 100 = 0"), **kw).collect())


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 70), st.integers(1, 70), st.integers(1, 70), st.integers(0, 10 ** 6))
def test_strassen_is_the_plain_product(m, k, n, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-10 ** 6, 10 ** 6, (m, k)), rng.integers(-10 ** 6, 10 ** 6, (k, n))
    assert (hn.strassen(a, b, leaf=4) == a @ b).all()
    assert (hn.strassen(a.astype(object), b.astype(object), leaf=8) == a @ b).all()


def test_scores_beyond_64_bits_are_exact():
    a, b = np.array([[1 << 40, -(1 << 40)]]), np.array([[1 << 40, 3]])
    assert hn.exact_scores(a, b)[0, 0] == (1 << 80) - 3 * (1 << 40)
    assert hn.quantised([[1e30], [2.0, -0.001]]).tolist() == [[int(np.floor(256e30)), 0], [512, -1]]


def test_mining_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).round(1).tolist(), int(rng.integers(0, 3))) for i in range(400)]
    assert mined(spark, rows) == brute(rows) != []
    assert mined(spark, rows, block_bytes=200) == brute(rows)  # one block per two anchors


def test_odd_rows(spark):
    rows = [(0, [1.0, 1.0], 0), (0, [1.0, 1.0], 0), (1, [1.0, 0.5], 0), (1, [1.0, 0.5], 0), (2, [0.5, 0.25], 1), (2, [0.5, 0.25], 1),
            (3, None, 1), (4, [None, 1.0], 1), (5, [float("nan"), 1.0], 1), (6, [float("inf")], 1), (None, [1.0, 1.0], 0), (8, [1.0], None),
            (9, [], 1), (10, [0.75], 1), (11, [0.5, 0.25], 2), (100, [3.0], 9)]
    assert mined(spark, rows) == brute(rows)
    assert [r[1] for r in mined(spark, rows)] == [1, 1, 1]


def test_hot_label_and_ties(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(300)] + [(i, [0.5, 0.0], 1) for i in range(300, 500)]
    found = mined(spark, rows)
    assert found == brute(rows)
    assert [r[3] for r in found if r[0] == 100 and r[1] == 0] == list(range(300, 310))


def test_scores_outside_long_are_returned_as_its_ends(spark):
    rows = [(0, [1e19, 0.0], 0), (1, [1e19, 0.0], 0), (2, [5e18, 0.0], 1)]
    assert mined(spark, rows) == [(0, 1, 1, 2, (1 << 63) - 1, (1 << 63) - 1)]


def test_empty_table(spark):
    assert mined(spark, []) == []


def test_extra_columns(spark, tmp_path):
    from pyspark.sql import functions as F
    rows = [(0, [1.0], 0), (14, [0.9], 9), (21, [0.5], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "tag", "vector", "anchor", "scores", "ids", "rank"):
        df = df.withColumn(name, F.lit("x"))
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    # 0 and 21 take the next label; 14 becomes 0 and is no positive
    assert hn.op12_hard_negatives(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_equals_its_sql(spark, sf):
    import duckdb
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/{sf}/embeddings.parquet'")
    want = sorted(con.sql(hn.OP12_SQL).fetchall())
    assert sorted(tuple(r) for r in hn.op12_hard_negatives(spark, f"/root/testdata/{sf}").collect()) == want
