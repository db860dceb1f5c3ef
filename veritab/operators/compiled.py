"""Fitted models as plain expressions.

``dump`` turns a fitted model into a small JSON document; ``score_column`` makes it one ``Column``, so that
scoring needs no Python and no ML library and stays in generated code, and ``score_sql`` the same
expression as SQL text for any engine with CASE, EXP and ISNAN. The document:

- linear: ``{"kind": "linear", "bias": b, "weights": [w0, w1, ...]}``, probability ``1 / (1 + exp(-(b + sum w*x)))``;
  null where an input is null.
- trees: ``{"kind": "trees", "link": "mean" | "logistic", "trees": [node, ...]}``: mean of the leaves of a
  forest, or the logistic function of the sum of the leaves of boosted trees. A node is ``{"leaf": v}`` or
  ``{"feature": i, "cut": c, "missing": "left" | "right", "left": node, "right": node}``; a row goes left when its
  value is at most ``cut``, and to ``missing`` when it is null or NaN.

Expressions grow with the number of nodes; Spark evaluates one too long for generated code without it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.operators.boosting import BoostedModel, Tree


# ---------------- model -> document ----------------
def dump(model) -> dict:  # noqa: ANN001
    """Document of a fitted logistic regression, random forest (two classes) or boosted trees; of a pipeline's last stage."""
    if isinstance(model, PipelineModel):
        model = model.stages[-1]
    if isinstance(model, LogisticRegressionModel):
        return {"kind": "linear", "bias": float(model.intercept), "weights": [float(w) for w in model.coefficients]}
    if isinstance(model, RandomForestClassificationModel):
        if model.numClasses != 2:
            raise ValueError("only forests of two classes have one probability")
        return {"kind": "trees", "link": "mean", "trees": [_forest_node(t._java_obj.rootNode()) for t in model.trees]}
    if isinstance(model, BoostedModel):
        return {"kind": "trees", "link": "logistic", "trees": [_boosted_node(t, 0) for t in model.trees]}
    raise TypeError(f"no expression for {type(model).__name__}")


def _forest_node(node) -> dict:  # noqa: ANN001
    if node.getClass().getSimpleName() == "LeafNode":
        stats = np.array(list(node.impurityStats().stats()), dtype=np.float64)
        return {"leaf": float(stats[1] / stats.sum()) if stats.sum() else 0.0}
    split = node.split()
    if split.getClass().getSimpleName() != "ContinuousSplit":
        raise TypeError("splits on category sets have no cut")
    return {"feature": int(split.featureIndex()), "cut": float(split.threshold()), "missing": "right",
            "left": _forest_node(node.leftChild()), "right": _forest_node(node.rightChild())}


def _boosted_node(tree: Tree, at: int) -> dict:
    if tree.feature[at] < 0:
        return {"leaf": float(tree.value[at])}
    return {"feature": int(tree.feature[at]), "cut": float(tree.cut[at]), "missing": "left" if tree.missing_left[at] else "right",
            "left": _boosted_node(tree, 2 * at + 1), "right": _boosted_node(tree, 2 * at + 2)}


def write_dump(spark: SparkSession, document: Mapping, path: str) -> None:
    """The document as one line of text."""
    spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_dump(spark: SparkSession, path: str) -> dict:
    """A written document."""
    return json.loads(spark.read.text(path).first()[0])


# ---------------- document -> expression ----------------
def score_column(document: Mapping, feature: Callable[[int], Column]) -> Column:
    """Probability of class 1; ``feature(i)`` is the column of feature i."""
    x = lambda i: feature(i).cast("double")
    if document["kind"] == "linear":
        return _logistic(sum((x(i) * F.lit(w) for i, w in enumerate(document["weights"])), F.lit(document["bias"])))

    def value(node: Mapping) -> Column:
        if "leaf" in node:
            return F.lit(node["leaf"])
        v, left, right = x(node["feature"]), value(node["left"]), value(node["right"])
        return (F.when(v.isNull() | F.isnan(v), left if node["missing"] == "left" else right)
                .when(v <= F.lit(node["cut"]), left).otherwise(right))

    total = sum((value(t) for t in document["trees"]), F.lit(0.0))
    return _logistic(total) if document["link"] == "logistic" else total / F.lit(float(max(len(document["trees"]), 1)))


def _logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def score_sql(document: Mapping, feature: Callable[[int], str]) -> str:
    """SQL text of :func:`score_column`; ``feature(i)`` is the SQL expression of feature i."""
    number = lambda v: f"CAST('{v!r}' AS DOUBLE)"
    x = lambda i: f"CAST({feature(i)} AS DOUBLE)"
    if document["kind"] == "linear":
        z = " + ".join([number(document["bias"]), *[f"{x(i)} * {number(w)}" for i, w in enumerate(document["weights"])]])
        return f"(1.0 / (1.0 + EXP(-({z}))))"

    def value(node: Mapping) -> str:
        if "leaf" in node:
            return number(node["leaf"])
        v, left, right = x(node["feature"]), value(node["left"]), value(node["right"])
        return (f"(CASE WHEN {v} IS NULL OR ISNAN({v}) THEN {left if node['missing'] == 'left' else right} "
                f"WHEN {v} <= {number(node['cut'])} THEN {left} ELSE {right} END)")

    total = "(" + " + ".join(["CAST('0.0' AS DOUBLE)", *[value(t) for t in document["trees"]]]) + ")"
    return f"(1.0 / (1.0 + EXP(-{total})))" if document["link"] == "logistic" else f"({total} / {max(len(document['trees']), 1)}.0)"


def score(df: DataFrame, document: Mapping, feature: Callable[[int], Column], threshold: float = 0.5) -> DataFrame:
    """G1: ``prediction_probability`` and ``prediction`` (null where the probability is null)."""
    return (df.withColumn("prediction_probability", score_column(document, feature))
            .withColumn("prediction", (F.col("prediction_probability") >= threshold).cast("int")))
