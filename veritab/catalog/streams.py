"""Streaming queries T1-T5: each runs a file stream to completion (availableNow) and returns
the sink; the SQL twin is the batch computation of the same windows. Windows are appended once the
watermark has passed their end, so the twins take the windows that end at or before the latest event time
less the watermark's delay."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritab.catalog.base import (SCORE_B, SCORE_W, SQL_LI_SCORED, li_scored, query, rounded, sql_round,
                                  tbl)
from veritab.catalog.evaluation import _PSQL, _conf_sql
from veritab.operators import evaluate as EV
from veritab.operators import rules as R
from veritab.sources.io import clean_nan
from veritab.streaming import windows as S

R6 = sql_round
_EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _events_stream(spark, sf):
    return clean_nan(S.file_stream(spark, f"{sf.rstrip('/')}/events.parquet"))


_T1_NULLS = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in _EV_COLS if c != "ts")


@query("t01_stream_window_quality",
       "WITH e AS (SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') AS ws, * FROM events) "
       "SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, "
       "strftime(ws + INTERVAL '1 day', '%Y-%m-%d %H:%M:%S') AS window_end, COUNT(*) AS n_rows, "
       f"{R6(f'SUM({_T1_NULLS}) * 100.0 / (COUNT(*) * 5)')} AS missing_percentage, "
       f"{R6(f'GREATEST(0.0, 100.0 - SUM({_T1_NULLS}) * 100.0 / (COUNT(*) * 5))')} AS quality_score, "
       f"CASE WHEN GREATEST(0.0, 100.0 - SUM({_T1_NULLS}) * 100.0 / (COUNT(*) * 5)) >= 90 THEN 'good' "
       f"WHEN GREATEST(0.0, 100.0 - SUM({_T1_NULLS}) * 100.0 / (COUNT(*) * 5)) >= 70 THEN 'warning' ELSE 'critical' END AS status, "
       f"{R6('AVG(value)')} AS mean_value, {R6('STDDEV_SAMP(value)')} AS std_value FROM e GROUP BY ws "
       "HAVING ws + INTERVAL '1 day' <= (SELECT MAX(ts) - INTERVAL '1 day' FROM events)")
def t01(spark, sf):
    w = S.window_quality(_events_stream(spark, sf), "ts", "1 day", "1 day",
                         columns=[c for c in _EV_COLS if c != "ts"], value="value")
    return rounded(S.run_available_now(w, "t01"))


_REF_END = "2024-01-08"


@query("t02_stream_window_cv_drift",
       f"WITH r AS (SELECT event_type, COUNT(value) AS ref_n, STDDEV_SAMP(value) / AVG(value) AS ref_cv FROM events "
       f"WHERE ts < TIMESTAMP '{_REF_END}' GROUP BY event_type), "
       "w AS (SELECT time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS ws, event_type, COUNT(value) AS n, "
       "STDDEV_SAMP(value) / AVG(value) AS cv FROM events GROUP BY 1, 2) "
       "SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(ws + INTERVAL '7 days', '%Y-%m-%d %H:%M:%S') AS window_end, "
       f"w.event_type, n, {R6('cv')} AS cv, {R6('ref_cv')} AS ref_cv, "
       f"{R6('CASE WHEN n > 1 AND ref_n > 1 THEN LEAST(1.0, COALESCE(ABS(cv - ref_cv) / GREATEST(ref_cv, 0.001), 0.0)) ELSE 0.0 END')} AS drift_score "
       "FROM w JOIN r ON w.event_type = r.event_type "
       "WHERE ws + INTERVAL '7 days' <= (SELECT MAX(ts) - INTERVAL '7 days' FROM events)")
def t02(spark, sf):
    ref = tbl(spark, sf, "events").where(F.col("ts") < F.lit(_REF_END).cast("timestamp_ntz"))
    w = S.window_cv_drift(_events_stream(spark, sf), ref, "ts", "value", ["event_type"], "7 days", "7 days")
    return rounded(S.run_available_now(w, "t02"))


def _scored_stream(spark, sf):
    from veritab.catalog.base import LI_KEY, NOISE_SEED
    from veritab.functions.scalar import uniform_hash
    from veritab.operators.score import linear_score
    li = clean_nan(S.file_stream(spark, f"{sf.rstrip('/')}/lineitem.parquet"))
    z = sum((F.col(c) * w for c, w in SCORE_W), F.lit(SCORE_B))
    u = uniform_hash(*LI_KEY, seed=NOISE_SEED)
    return (li.withColumn("score", F.round(linear_score(dict(SCORE_W), SCORE_B), 9))
            .withColumn("label", ((z + 3 * (u - 0.5)) > 0).cast("int"))
            .withColumn("prediction", (F.col("score") >= 0.5).cast("int")))


_T3_SQL = (f"WITH {SQL_LI_SCORED}, w AS (SELECT time_bucket(INTERVAL '1 day', l_shipdate, TIMESTAMP '1970-01-01') AS ws, "
           "CAST(SUM(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp, "
           "CAST(SUM(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp, "
           "CAST(SUM(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn, "
           "CAST(SUM(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn FROM ls GROUP BY 1), "
           "m AS (SELECT *, (tp + tn) * 1.0 / (tp + fp + fn + tn) AS accuracy, "
           "CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0 END AS precision, "
           "CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0 END AS recall FROM w), "
           "mf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m)")


@query("t03_stream_window_performance",
       f"{_T3_SQL} SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, "
       "strftime(ws + INTERVAL '1 day', '%Y-%m-%d %H:%M:%S') AS window_end, tp, fp, fn, tn, "
       f"{R6('accuracy')} AS accuracy, {R6('precision')} AS precision, {R6('recall')} AS recall, {R6('f1')} AS f1 FROM mf "
       "WHERE ws + INTERVAL '1 day' <= (SELECT MAX(l_shipdate) - INTERVAL '1 day' FROM lineitem)")
def t03(spark, sf):
    w = S.window_performance(_scored_stream(spark, sf), "l_shipdate", "label", "prediction", "1 day", "1 day")
    return rounded(S.run_available_now(w, "t03"))


@query("t04_stream_scoring_log",
       f"WITH s AS (SELECT {_PSQL} AS p FROM lineitem) SELECT CASE WHEN p >= 0.5 THEN 'Maligno' WHEN p IS NOT NULL THEN 'Benigno' END AS prediction_label, "
       f"{_conf_sql('p')} AS confidence, COUNT(*) AS n, {R6('AVG(p)')} AS mean_probability FROM s GROUP BY 1, 2")
def t04(spark, sf):
    li = clean_nan(S.file_stream(spark, f"{sf.rstrip('/')}/lineitem.parquet"))
    s = S.score_stream(li, dict(SCORE_W), SCORE_B, [c for c, _ in SCORE_W], ts="l_shipdate")
    log = S.run_available_now(s, "t04", mode="append", fmt="json")
    return rounded(log.groupBy("prediction_label", "confidence").agg(
        F.count(F.lit(1)).alias("n"), F.avg("probability").alias("mean_probability")))


@query("t05_stream_alerts",
       f"{_T3_SQL}, fm AS (SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS scope, * FROM mf "
       "WHERE ws + INTERVAL '1 day' <= (SELECT MAX(l_shipdate) FROM lineitem)), "
       "ml AS (SELECT scope, x.metric, x.value FROM fm, LATERAL (VALUES ('accuracy', accuracy), ('precision', precision), "
       "('recall', recall), ('f1', f1)) x(metric, value)), "
       "r AS (SELECT * FROM (VALUES ('low_accuracy', 'accuracy', 0.85, 'Low accuracy: '), ('low_recall', 'recall', 0.9, 'Low recall: '), "
       "('low_precision', 'precision', 0.8, 'Low precision: '), ('low_f1', 'f1', 0.85, 'Low F1: ')) r(rule, metric, lim, msg)) "
       f"SELECT rule, scope, ml.metric, {R6('value')} AS value, {R6('lim')} AS \"limit\", "
       "msg || scope || ' ' || printf('%.2f', value) AS message, 'performance' AS type, substr(scope, 1, 10) AS date "
       "FROM ml JOIN r ON ml.metric = r.metric WHERE value < lim")
def t05(spark, sf):
    w = S.window_performance(_scored_stream(spark, sf), "l_shipdate", "label", "prediction", "1 day", "0 seconds")
    alerts = S.run_alert_stream(w, R.rule_table(spark, R.PERFORMANCE_RULES[:4]), "t05")
    return rounded(alerts.select("rule", "scope", "metric", "value", "limit", "message", "type",
                                 F.col("date").cast("string").alias("date")))
