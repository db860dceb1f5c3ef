import duckdb
import numpy as np
import pytest

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from veritab.operators import boosting as B
from veritab.operators import compiled as C
from veritab.operators import models as M

D = 4


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(150, D)), 2)
    y = (x[:, 0] - x[:, 1] * x[:, 2] + 0.5 * rng.normal(size=150) > 0).astype(int)
    rows = [(i, [float(v) for v in r], int(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, x array<double>, label int")
    return df.withColumn("features", array_to_vector("x")).withColumn("weight", F.lit(1.0)), x


def _fitted(df, kind):
    if kind == "linear":
        return M.as_pipeline(M.logistic(n=150)).fit(df)
    if kind == "forest":
        return M.random_forest(num_trees=7, max_depth=4).fit(df)
    return B.BoostedTrees("x", ("id",), rounds=6, max_depth=3).fit(df)


@pytest.mark.parametrize("kind", ["linear", "forest", "boosted"])
def test_expression_and_sql_equal_the_model(spark, data, tmp_path, kind):
    df, x = data
    model = _fitted(df, kind)
    want = [r[0] for r in model.transform(df).orderBy("id").select(vector_to_array("probability")[1]).collect()]
    C.write_dump(spark, C.dump(model), str(tmp_path / "dump"))
    document = C.read_dump(spark, str(tmp_path / "dump"))
    assert document == C.dump(model)
    scored = C.score(df, document, lambda i: F.col("x")[i])
    got = [r[0] for r in scored.orderBy("id").select("prediction_probability").collect()]
    assert np.allclose(got, want, atol=1e-12)
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id BIGINT, x DOUBLE[])")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(i, [float(v) for v in r]) for i, r in enumerate(x)])
    sql = [r[0] for r in con.execute(f"SELECT {C.score_sql(document, lambda i: f'x[{i + 1}]')} FROM t ORDER BY id").fetchall()]
    assert np.allclose(sql, want, atol=1e-12)


def test_missing_values(spark, data):
    df, _ = data
    model = _fitted(df, "boosted")
    odd = spark.createDataFrame([(0, [None, 0.1, float("nan"), 0.2]), (1, [float("nan")] * D), (2, [0.0, None, None, None])], "id long, x array<double>")
    want = [r[0] for r in model.transform(odd).orderBy("id").select(vector_to_array("probability")[1]).collect()]
    got = [r[0] for r in C.score(odd, C.dump(model), lambda i: F.col("x")[i]).orderBy("id").select("prediction_probability").collect()]
    assert np.allclose(got, want, atol=1e-12)
    linear = C.score(odd, {"kind": "linear", "bias": 0.0, "weights": [1.0]}, lambda i: F.col("x")[i]).orderBy("id").collect()
    assert linear[0].prediction_probability is None and linear[0].prediction is None and linear[2].prediction_probability == 0.5


def test_no_trees_and_unknown_models(spark):
    one = spark.createDataFrame([(1.0,)], "a double")
    p = C.score(one, C.dump(B.BoostedModel([], "x", 0)), lambda i: F.col("a")).first()
    assert p.prediction_probability == 0.5 and p.prediction == 1
    with pytest.raises(TypeError):
        C.dump(object())
