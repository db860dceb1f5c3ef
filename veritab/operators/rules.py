"""Threshold rules over metric tables (Q7, Q8, D7, V4, V5, M26) and readiness.

A rule row names a metric, a comparison, a limit and a message format; metrics are
long rows ``(scope, metric, value)``. Rules are a small literal table (bounded by the
rule set) joined by broadcast; alerts are the matching rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab import thresholds as T
from veritab.functions.scalar import fmt_fixed

RULE_SCHEMA = "rule string, metric string, op string, limit double, message string"

# (rule, metric, comparison, limit, message prefix; the scope and the value follow it)
QUALITY_RULES = [
    ("low_quality_score", "quality_score", "<", T.QUALITY_SCORE_THRESHOLD, "Low data quality score: "),
    ("too_many_missing", "missing_share", ">", T.MISSING_VALUES_THRESHOLD, "Too many missing values: "),
    ("too_many_duplicates", "duplicate_share", ">", T.DUPLICATE_ROWS_THRESHOLD, "Too many duplicate rows: "),
]
OUTLIER_RULES = [
    ("too_many_outliers", "outlier_share", ">", T.OUTLIERS_THRESHOLD, "Too many outliers: "),
]
DRIFT_RULES = [
    ("dataset_drift", "dataset_drift", ">=", 1.0, "Dataset drift detected: "),
    ("drift_share_high", "drift_share", ">", T.STATISTICAL_TEST_THRESHOLD, "High drift share: "),
    ("too_many_drifted_columns", "drifted_feature_share", ">", T.DRIFTED_FEATURES_SHARE,
     "Too many drifted columns: "),
    ("column_drift_significant", "column_drift_score", ">", T.COLUMN_DRIFT_SCORE_ALERT,
     "Significant drift in column: "),
]
PERFORMANCE_RULES = [
    ("low_accuracy", "accuracy", "<", T.ACCURACY_THRESHOLD, "Low accuracy: "),
    ("low_recall", "recall", "<", T.RECALL_THRESHOLD, "Low recall: "),
    ("low_precision", "precision", "<", T.PRECISION_THRESHOLD, "Low precision: "),
    ("low_f1", "f1", "<", T.F1_THRESHOLD, "Low F1: "),
    ("performance_drift", "abs_drift", ">", T.PREDICTION_DRIFT_THRESHOLD, "Performance drift: "),
]


def rule_table(spark: SparkSession, rules: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], RULE_SCHEMA)


def apply_rules(metrics: DataFrame, rules: DataFrame, scope: str = "scope",
                digits: int = 2) -> DataFrame:
    """Alerts: metric rows joined with rule rows on the metric name, kept where the
    comparison fires. Output ``(rule, scope, metric, value, limit, message)``."""
    j = metrics.join(F.broadcast(rules), on="metric", how="inner")
    v, lim, op = F.col("value"), F.col("limit"), F.col("op")
    fired = (F.when(op == "<", v < lim).when(op == "<=", v <= lim).when(op == ">", v > lim)
             .when(op == ">=", v >= lim).otherwise(F.lit(False)))
    msg = F.concat(F.col("message"), F.coalesce(F.col(scope), F.lit("")), F.lit(" "), fmt_fixed(v, digits))
    return j.where(fired).select("rule", F.col(scope).alias("scope"), "metric", "value", "limit",
                                 msg.alias("message"))


def readiness(metrics: DataFrame, rules: DataFrame, scope: str = "scope") -> DataFrame:
    """Ready when no rule fires; ``bool_and`` over the rule outcomes."""
    j = metrics.join(F.broadcast(rules), on="metric", how="inner")
    v, lim, op = F.col("value"), F.col("limit"), F.col("op")
    fired = (F.when(op == "<", v < lim).when(op == "<=", v <= lim).when(op == ">", v > lim)
             .when(op == ">=", v >= lim).otherwise(F.lit(False)))
    return j.agg(F.count(F.lit(1)).alias("rules_checked"), F.count_if(fired).alias("rules_fired"),
                 F.coalesce(F.bool_and(~fired), F.lit(True)).alias("ready"))
