"""Empty tables, null inputs, wide chi-square tests and distributed label order."""

import math

import pytest
from pyspark.sql import functions as F

from veritab.functions.scalar import chi2_sf, confidence_band, label_text
from veritab.operators import drift as D
from veritab.operators import evaluate as EV
from veritab.operators import features as FE
from veritab.operators import models as M
from veritab.operators import profile as P
from veritab.operators import quality as Q
from veritab.operators import score as S
from veritab.roles import Roles


def chi2_tail(dof, x):
    """Sum over all terms, by logarithms of the gamma function."""
    a, y, j = dof / 2, x / 2, 0.5 if dof % 2 else 0.0
    first = math.erfc(math.sqrt(y)) if dof % 2 else 0.0
    terms = []
    while j < a - 1e-9:
        terms.append(math.exp(-y + j * math.log(y) - math.lgamma(j + 1)))
        j += 1
    return first + math.fsum(terms)


def test_chi_square_tail_at_any_degrees_of_freedom(spark):
    cases = [(d, d + k * math.sqrt(2 * d)) for d in (1, 2, 3, 10, 51, 1000, 2000, 2001, 10_000, 100_001, 1_000_000)
             for k in (-0.5, 0, 1, 3, 6) if d + k * math.sqrt(2 * d) > 0]
    rows = spark.createDataFrame(cases, "dof long, x double").select("dof", "x", chi2_sf("x", "dof").alias("p")).collect()
    for r in rows:
        want = chi2_tail(r.dof, r.x)
        assert r.p == pytest.approx(want, rel=1e-7, abs=1e-12), (r.dof, r.x)


def test_chi_square_table_values(spark):
    rows = [(1, 3.841, 0.05), (10, 18.307, 0.05), (100, 124.342, 0.05), (1000, 1074.679, 0.05), (2_000_000, 2_004_000.0, 0.0228)]
    for r in spark.createDataFrame(rows, "dof long, x double, p double").withColumn("q", chi2_sf("x", "dof")).collect():
        assert r.q == pytest.approx(r.p, abs=2e-4)


def test_null_in_null_out(spark):
    df = spark.createDataFrame([(None, None), (0.95, 1)], "p double, c int")
    got = df.select(confidence_band("p").alias("b"), label_text("c").alias("l")).collect()
    assert (got[0].b, got[0].l) == (None, None) and None not in (got[1].b, got[1].l)
    scored = S.score_linear(spark.createDataFrame([(None,), (3.0,)], "a double"), {"a": 1.0}, 0.0).collect()
    assert scored[0].prediction is None and scored[0].prediction_label is None and scored[0].confidence is None
    assert scored[1].prediction == 1


def test_records_of_a_request_array(spark):
    df = spark.createDataFrame([([{"a": 1.0, "b": 2.0}, {"a": None, "b": 1.0}, None, {"a": 1.0}],)], "records array<map<string,double>>")
    got = {r.id: r for r in S.score_records(S.explode_batch(df, "records"), "record", {"a": 1.0, "b": 1.0}, 0.0, "id").collect()}
    assert got[0].prediction == 1 and got[0].error is None and got[0].features_used == ["a", "b"]
    assert [got[i].error for i in (1, 2, 3)] == ["null features: a", "record is null", "missing features: b"]
    assert all(got[i][c] is None for i in (1, 2, 3) for c in ("prediction", "probability", "confidence", "prediction_label", "features_used"))


def test_zero_and_empty_cases(spark):
    zero = spark.createDataFrame([("a", 0.0), ("b", 0.0)], "feature string, x double")
    assert [r.normalised for r in P.normalise_by_max(zero, "x").collect()] == [None, None]
    coef = zero.withColumnRenamed("x", "coefficient")
    perm = zero.withColumnRenamed("x", "importance_mean")
    assert {r.coefficient_norm for r in EV.combine_importance(coef, perm).collect()} == {None}
    empty = spark.createDataFrame([], "a double, t string")
    assert Q.structure_validation(empty, Roles(numeric=["a"], categorical=[], target="t")).count() == 0
    none = spark.createDataFrame([], "feature string, drifted boolean")
    assert D.dataset_drift(none).first().drift_share is None
    assert P.duplicate_rows(empty).first().duplicates == 0


def test_duplicates_over_all_columns(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, 1, "x"), (1, 1, "x"), (1, 1, None), (1, 1, None), (1, 1, None)]
    got = P.duplicate_rows(spark.createDataFrame(rows, "a int, b int, c string")).first()
    assert (got.n_rows, got.duplicates) == (7, 3)


def test_label_order_is_alphabetical(spark):
    df = spark.createDataFrame([(v,) for v in ["m", "b", None, "z", "b", "a"]], "t string")
    enc, mapping = FE.encode_target(df, "t", "i")
    assert {r["value"]: r["index"] for r in mapping.collect()} == {"a": 0, "b": 1, "m": 2, "z": 3}
    assert sorted((r.t, r.i) for r in enc.where("t is not null").collect()) == [("a", 0), ("b", 1), ("b", 1), ("m", 2), ("z", 3)]
    assert enc.count() == 6


def test_class_weights_come_from_the_training_rows(spark):
    df = spark.createDataFrame([(1, 9.0, 0), (0, 9.0, 0), (0, 9.0, 0), (1, 9.0, 1)], "label int, weight double, fold int")
    got = {r.label: r.weight for r in M.training_part(df.where("fold = 0")).collect()}
    assert got == {1: pytest.approx(1.5), 0: pytest.approx(0.75)}


def test_running_sums_do_not_depend_on_the_shuffle_width(spark):
    from veritab.operators.cumulative import running_sums
    df = spark.range(3000).select((F.col("id") % 700).cast("double").alias("v"), (F.col("id") % 3).alias("g"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    for width in ("2", "600"):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        out.append(sorted(map(tuple, running_sums(df, "v", {"n": F.lit(1)}, ["g"], next_value=True).collect()), key=str))
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]
