"""Quotas by radix selection equal the ranks of a plain sort."""
import hashlib

import pytest
from pyspark.sql import functions as F

from veritab.operators import features as FE
from veritab.operators import radix


def key_of(i):
    return hashlib.md5(str(i).encode()).hexdigest()


def rows_of(spark, items):
    return spark.createDataFrame(items, "_lbl string, _h string")


@pytest.mark.parametrize("digits", [1, 3])
def test_limits_equal_sorted_ranks(spark, digits, monkeypatch):
    monkeypatch.setattr(radix, "DIGITS", digits)
    items = [("abc"[i % 3] if i % 7 else None, key_of(i)) for i in range(500)]
    sizes = {c: sorted(h for x, h in items if x == c) for c in ("a", "b", "c", None)}
    quota = {"a": 1, "b": 17, "c": len(sizes["c"]), None: 0}
    got = radix.limits(rows_of(spark, items), spark.createDataFrame(list(quota.items()), "_lbl string, quota long")).collect()
    for r in got:
        inside = [h for h in sizes[r["_lbl"]] if r["limit"] is not None and h <= r["limit"]]
        assert inside == sizes[r["_lbl"]][:quota[r["_lbl"]]]


def test_equal_keys_fall_together_and_absent_classes(spark):
    items = [("a", key_of(1))] * 5 + [("a", key_of(2))]
    quotas = spark.createDataFrame([("a", 2), ("gone", 3)], "_lbl string, quota long")
    got = {r["_lbl"]: r["limit"] for r in radix.limits(rows_of(spark, items), quotas).collect()}
    inside = sum(h <= got["a"] for _, h in items)
    assert inside == (5 if key_of(1) < key_of(2) else 6) and got["gone"] is None


def test_split_has_no_window_over_rows(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    out = FE.stratified_split(df, "l_returnflag", ["l_orderkey", "l_linenumber"], 0.2, 42)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
    sizes = {r["l_returnflag"]: (r["n"], r["t"]) for r in out.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect()}
    total = sum(n for n, _ in sizes.values())
    assert sum(t for _, t in sizes.values()) == -(-total // 5)
    assert all(abs(t - n * 0.2) < 1.01 for n, t in sizes.values())
    assert out.columns == [*df.columns, "split"]


def test_digits_follow_the_rows():
    assert [radix.digits_for(n) for n in (0, 32_000, 32_001, 10 ** 12)] == [1, 1, 2, 8]
