"""Evaluation and scoring queries: M10-M16, M24, V1-V5, W5, A17, A20, P8, G2-G4."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritab.catalog.base import (LI_KEY, SCORE_B, SCORE_W, SQL_LI_SCORED, li_scored, query, rounded,
                                  sql_round, sql_union, tbl)
from veritab.operators import evaluate as EV
from veritab.operators import features as FE
from veritab.operators import profile as P
from veritab.operators import rules as R
from veritab.operators import score as SC
from veritab.operators import shape as S

R6 = sql_round
W = "WITH " + SQL_LI_SCORED


def _cells_sql(src="ls", by="", weight="1"):
    b = f"{by}, " if by else ""
    g = f" GROUP BY {by}" if by else ""
    return (f"SELECT {b}CAST(SUM(CASE WHEN label = 1 AND prediction = 1 THEN {weight} ELSE 0 END) AS BIGINT) AS tp, "
            f"CAST(SUM(CASE WHEN label = 0 AND prediction = 1 THEN {weight} ELSE 0 END) AS BIGINT) AS fp, "
            f"CAST(SUM(CASE WHEN label = 1 AND prediction = 0 THEN {weight} ELSE 0 END) AS BIGINT) AS fn, "
            f"CAST(SUM(CASE WHEN label = 0 AND prediction = 0 THEN {weight} ELSE 0 END) AS BIGINT) AS tn FROM {src}{g}")


_M11 = ("CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn) * 1.0 / (tp + fp + fn + tn) ELSE 0 END AS accuracy, "
        "CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0 END AS precision, "
        "CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0 END AS recall")
_F1 = ("CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1")


def _metrics_sql(cells_cte: str, by: str = "") -> str:
    b = f"{by}, " if by else ""
    return (f"mc AS (SELECT {b}tp, fp, fn, tn, {_M11} FROM {cells_cte}), "
            f"mm AS (SELECT *, {_F1} FROM mc)")


def _r_metrics(by=""):
    b = f"{by}, " if by else ""
    return (f"SELECT {b}tp, fp, fn, tn, {R6('accuracy')} AS accuracy, {R6('precision')} AS precision, "
            f"{R6('recall')} AS recall, {R6('f1')} AS f1 FROM mm")


@query("m10_confusion_matrix",
       f"{W}, c AS ({_cells_sql()}) SELECT 0 AS actual, 0 AS predicted, tn AS n FROM c UNION ALL "
       "SELECT 0, 1, fp FROM c UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c")
def m10(spark, sf):
    return EV.confusion(li_scored(spark, sf), "label", "prediction")


@query("m11_classification_metrics", f"{W}, c AS ({_cells_sql()}), {_metrics_sql('c')} {_r_metrics()}")
def m11(spark, sf):
    return rounded(EV.classification_metrics(li_scored(spark, sf), "label", "prediction"))


def _rank_sql(src, by="", weight="1"):
    b = f"{by}, " if by else ""
    p = f"PARTITION BY {by} " if by else ""
    g = f"{by}, " if by else ""
    return (f"rk0 AS (SELECT {b}score, SUM(CASE WHEN label = 1 THEN {weight} ELSE 0 END) AS pos, "
            f"SUM(CASE WHEN label = 0 THEN {weight} ELSE 0 END) AS neg FROM {src} GROUP BY {g}score), "
            f"rk AS (SELECT *, SUM(pos) OVER ({p}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos, "
            f"SUM(neg) OVER ({p}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg, "
            f"SUM(pos) OVER ({p[:-1] if p else ''}) AS tot_pos, SUM(neg) OVER ({p[:-1] if p else ''}) AS tot_neg FROM rk0)")


def _auc_expr():
    return ("CASE WHEN MAX(tot_pos) > 0 AND MAX(tot_neg) > 0 THEN SUM(pos * (cum_neg - neg + neg / 2.0)) "
            "/ (MAX(tot_pos) * MAX(tot_neg)) END")


def _ap_expr():
    tp, fp = "(tot_pos - (cum_pos - pos))", "(tot_neg - (cum_neg - neg))"
    return (f"CASE WHEN MAX(tot_pos) > 0 THEN COALESCE(SUM(CASE WHEN pos > 0 THEN pos * {tp} / ({tp} + {fp}) END), 0) "
            "/ MAX(tot_pos) END")


@query("m12_roc_auc", f"{W}, {_rank_sql('ls')} SELECT {R6(_auc_expr())} AS roc_auc FROM rk")
def m12(spark, sf):
    return rounded(EV.roc_auc(li_scored(spark, sf), "label", "score"))


@query("m13_average_precision", f"{W}, {_rank_sql('ls')} SELECT {R6(_ap_expr())} AS average_precision FROM rk")
def m13(spark, sf):
    return rounded(EV.average_precision(li_scored(spark, sf), "label", "score"))


@query("m14_per_class_metrics",
       f"{W}, c AS ({_cells_sql()}), pc AS (SELECT 1 AS class, tp AS a, fp AS b, fn AS d FROM c UNION ALL "
       "SELECT 0, tn, fn, fp FROM c), pr AS (SELECT class, CASE WHEN a + b > 0 THEN a * 1.0 / (a + b) ELSE 0 END AS precision, "
       "CASE WHEN a + d > 0 THEN a * 1.0 / (a + d) ELSE 0 END AS recall, a + d AS support FROM pc) "
       f"SELECT class, {R6('precision')} AS precision, {R6('recall')} AS recall, "
       f"{R6('CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END')} AS f1, "
       "CAST(support AS BIGINT) AS support FROM pr")
def m14(spark, sf):
    return rounded(EV.per_class_metrics(li_scored(spark, sf), "label", "prediction"))


BOOT_B = 1000

#: cells of equal rows and, per replicate, draws from Poisson(n) at uniform numbers of 32 bits from md5
SQL_DRAWS = (
    "cell AS (SELECT CAST(label AS BIGINT) AS label, CAST(prediction AS BIGINT) AS prediction, CAST(ROUND(score * 1e9) AS BIGINT) AS score, "
    "COUNT(*) AS n FROM ls GROUP BY ALL), "
    "ks AS (SELECT n, UNNEST(range(CAST(GREATEST(0, TRUNC(n - 8 * SQRT(n) - 20)) AS BIGINT), CAST(TRUNC(n + 8 * SQRT(n) + 20) AS BIGINT) + 1)) AS k "
    "FROM (SELECT DISTINCT n FROM cell)), "
    "cdf AS (SELECT n, k, SUM(EXP(k * LN(n) - n - LGAMMA(k + 1))) OVER (PARTITION BY n ORDER BY k) AS c FROM ks), "
    "bounds AS (SELECT n, k, COALESCE(LAG(c) OVER (PARTITION BY n ORDER BY k), 0) AS lower FROM cdf), "
    f"md AS (SELECT cell.*, b.block, md5(concat_ws('|', label, prediction, score, b.block, '42')) AS h FROM cell CROSS JOIN range(0, {BOOT_B // 4}) b(block)), "
    "us AS (SELECT label, prediction, score, n, block * 4 + j AS replicate, ('0x' || substr(h, CAST(8 * j + 1 AS INTEGER), 8))::BIGINT / 2^32 AS u "
    "FROM md CROSS JOIN range(0, 4) r(j)), "
    "bw AS (SELECT us.label, us.prediction, us.score, us.replicate, b.k AS bw FROM us ASOF JOIN bounds b ON us.n = b.n AND us.u >= b.lower)")


def _boot_sql():
    boot = (f"{SQL_DRAWS}, "
            f"bc AS (SELECT replicate, SUM(CASE WHEN label = 1 AND prediction = 1 THEN bw ELSE 0 END) AS tp, "
            "SUM(CASE WHEN label = 0 AND prediction = 1 THEN bw ELSE 0 END) AS fp, "
            "SUM(CASE WHEN label = 1 AND prediction = 0 THEN bw ELSE 0 END) AS fn, "
            "SUM(CASE WHEN label = 0 AND prediction = 0 THEN bw ELSE 0 END) AS tn FROM bw GROUP BY replicate), "
            f"{_metrics_sql('bc', 'replicate')}, {_rank_sql('bw', 'replicate', 'bw')}, "
            f"ra AS (SELECT replicate, {_auc_expr()} AS roc_auc, {_ap_expr()} AS average_precision FROM rk GROUP BY replicate), "
            "bl AS (SELECT mm.replicate, m.metric, m.value FROM mm JOIN ra ON mm.replicate = ra.replicate, "
            "LATERAL (VALUES ('accuracy', accuracy), ('precision', precision), ('recall', recall), ('f1', f1), "
            "('roc_auc', roc_auc), ('average_precision', average_precision)) m(metric, value))")
    return boot


@query("m15_bootstrap_metrics",
       f"{W}, {_boot_sql()} SELECT CAST(replicate AS INTEGER) AS replicate, metric, {R6('value')} AS value FROM bl")
def m15(spark, sf):
    long = EV.bootstrap_metrics(li_scored(spark, sf), "label", "prediction", "score", BOOT_B, 42)
    return rounded(long)


@query("m16_bootstrap_summary",
       f"{W}, {_boot_sql()} SELECT metric, {R6('AVG(value)')} AS mean, {R6('STDDEV_POP(value)')} AS std, "
       f"{R6('QUANTILE_CONT(value, 0.025)')} AS ci95_low, {R6('QUANTILE_CONT(value, 0.975)')} AS ci95_high, "
       f"{R6('QUANTILE_CONT(value, 0.005)')} AS ci99_low, {R6('QUANTILE_CONT(value, 0.995)')} AS ci99_high "
       "FROM bl GROUP BY metric")
def m16(spark, sf):
    long = EV.bootstrap_metrics(li_scored(spark, sf), "label", "prediction", "score", BOOT_B, 42)
    return rounded(EV.bootstrap_summary(long))


@query("m24_error_analysis",
       f"{W} SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE label <> prediction) AS errors, "
       "COUNT(*) FILTER (WHERE label = 0 AND prediction = 1) AS false_positives, "
       "COUNT(*) FILTER (WHERE label = 1 AND prediction = 0) AS false_negatives, "
       f"{R6('AVG(CASE WHEN label <> prediction THEN score END)')} AS mean_error_probability FROM ls")
def m24(spark, sf):
    return rounded(EV.error_analysis(li_scored(spark, sf), "label", "prediction", "score"))


@query("p08_misclassified_rows",
       f"{W} SELECT label, COUNT(*) AS n, {R6('AVG(score)')} AS mean_score FROM ls "
       "WHERE label <> prediction GROUP BY label")
def p08(spark, sf):
    m = S.misclassified(li_scored(spark, sf), "label", "prediction", keep=["label", "prediction", "score"])
    return rounded(m.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score")))


_A20 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a20_error_feature_stats",
       f"{W}, e AS (SELECT * FROM ls WHERE label <> prediction), s AS ("
       + sql_union([f"SELECT '{c}' AS feature, AVG({c}) AS mean, STDDEV_SAMP({c}) AS std FROM e" for c in _A20])
       + f") SELECT feature, {R6('mean')} AS mean, {R6('std')} AS std FROM s ORDER BY std DESC NULLS LAST, feature LIMIT 5")
def a20(spark, sf):
    return rounded(P.error_feature_stats(li_scored(spark, sf), "label", "prediction", _A20))


@query("a17_score_summary",
       f"{W} SELECT {R6('AVG(score)')} AS mean, {R6('MAX(score)')} AS max, {R6('MIN(score)')} AS min FROM ls")
def a17(spark, sf):
    return rounded(P.score_summary(li_scored(spark, sf), "score"))


@query("v01_performance_by_side",
       f"{W}, c AS ({_cells_sql(by='side')}), {_metrics_sql('c', 'side')} {_r_metrics('side')}")
def v01(spark, sf):
    return rounded(EV.performance_by_side(li_scored(spark, sf), "label", "prediction"))


@query("v02_confusion_by_side",
       f"{W}, c AS ({_cells_sql(by='side')}) SELECT side, 0 AS actual, 0 AS predicted, tn AS n FROM c UNION ALL "
       "SELECT side, 0, 1, fp FROM c UNION ALL SELECT side, 1, 0, fn FROM c UNION ALL SELECT side, 1, 1, tp FROM c")
def v02(spark, sf):
    return EV.confusion(li_scored(spark, sf), "label", "prediction", by=["side"])


_V3_CTE = (f"c AS ({_cells_sql(by='side')}), {_metrics_sql('c', 'side')}, "
           "ml AS (SELECT side, m.metric, m.value FROM mm, LATERAL (VALUES ('accuracy', accuracy), "
           "('precision', precision), ('recall', recall), ('f1', f1)) m(metric, value)), "
           "pd AS (SELECT metric, MAX(CASE WHEN side = 'reference' THEN value END) AS reference, "
           "MAX(CASE WHEN side = 'current' THEN value END) AS current FROM ml GROUP BY metric), "
           "pdd AS (SELECT *, current - reference AS drift FROM pd)")
_DIR = "CASE WHEN drift > 0 THEN 'increase' WHEN drift < 0 THEN 'decrease' ELSE 'unchanged' END"


@query("v03_performance_drift",
       f"{W}, {_V3_CTE} SELECT metric, {R6('reference')} AS reference, {R6('current')} AS current, "
       f"{R6('drift')} AS drift, {R6('CASE WHEN reference > 0 THEN drift / reference END')} AS relative_drift, "
       f"{_DIR} AS direction FROM pdd")
def v03(spark, sf):
    return rounded(EV.performance_drift(li_scored(spark, sf), "label", "prediction"))


@query("v04_performance_alerts",
       f"{W}, {_V3_CTE}, mt AS (SELECT 'current' AS scope, metric, current AS value FROM pdd UNION ALL "
       "SELECT metric, 'abs_drift', ABS(drift) FROM pdd), "
       "r AS (SELECT * FROM (VALUES ('low_accuracy', 'accuracy', '<', 0.85, 'Low accuracy: '), "
       "('low_recall', 'recall', '<', 0.9, 'Low recall: '), ('low_precision', 'precision', '<', 0.8, 'Low precision: '), "
       "('low_f1', 'f1', '<', 0.85, 'Low F1: '), ('performance_drift', 'abs_drift', '>', 0.1, 'Performance drift: ')) "
       "r(rule, metric, op, lim, msg)) "
       f"SELECT rule, scope, mt.metric, {R6('value')} AS value, {R6('lim')} AS \"limit\", "
       "msg || COALESCE(scope, '') || ' ' || printf('%.2f', value) AS message FROM mt JOIN r ON mt.metric = r.metric "
       "WHERE (op = '<' AND value < lim) OR (op = '>' AND value > lim)")
def v04(spark, sf):
    d = EV.performance_drift(li_scored(spark, sf), "label", "prediction")
    m = d.select(F.lit("current").alias("scope"), "metric", F.col("current").alias("value")).unionByName(
        d.select(F.col("metric").alias("scope"), F.lit("abs_drift").alias("metric"), F.abs("drift").alias("value")))
    return rounded(R.apply_rules(m, R.rule_table(spark, R.PERFORMANCE_RULES)))


@query("v05_performance_trends",
       f"{W}, {_V3_CTE} SELECT metric, {R6('drift')} AS drift, {_DIR} AS direction FROM pdd WHERE ABS(drift) > 0.05")
def v05(spark, sf):
    # no metric of these tables drifts beyond the default limit; see v05_any_trend
    return rounded(EV.performance_trends(EV.performance_drift(li_scored(spark, sf), "label", "prediction"), 0.05))


@query("v05_any_trend",
       f"{W}, {_V3_CTE} SELECT metric, {R6('drift')} AS drift, {_DIR} AS direction FROM pdd WHERE ABS(drift) > 0.00001")
def v05a(spark, sf):
    """Trends beyond a limit that these tables reach."""
    return rounded(EV.performance_trends(EV.performance_drift(li_scored(spark, sf), "label", "prediction"), 0.00001))


_MD5F = "md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, '42'))"


@query("w05_fold_range",
       f"{W}, fo AS (SELECT *, CAST((ROW_NUMBER() OVER (PARTITION BY label ORDER BY {_MD5F}) - 1) % 5 AS INTEGER) AS fold FROM ls), "
       f"c AS ({_cells_sql('fo', 'fold')}), {_metrics_sql('c', 'fold')}, "
       "ml AS (SELECT fold, m.metric, m.value FROM mm, LATERAL (VALUES ('accuracy', accuracy), ('precision', precision), "
       "('recall', recall), ('f1', f1)) m(metric, value)) "
       f"SELECT metric, {R6('AVG(value)')} AS mean, {R6('STDDEV_POP(value)')} AS std, {R6('MIN(value)')} AS min, "
       f"{R6('MAX(value)')} AS max, COUNT(*) AS n_folds FROM ml GROUP BY metric")
def w05(spark, sf):
    f = FE.stratified_folds(li_scored(spark, sf), "label", LI_KEY, 5, 42)
    wide = EV.classification_metrics(f, "label", "prediction", ["fold"])
    return rounded(EV.fold_range(EV.metrics_long(wide, ["fold"])))


_WMAP = dict(SCORE_W)


def _conf_sql(p):
    return (f"CASE WHEN {p} >= 0.9 THEN 'Molto Alta' WHEN {p} >= 0.8 THEN 'Alta' WHEN {p} >= 0.7 THEN 'Media' "
            f"WHEN {p} >= 0.6 THEN 'Bassa' ELSE 'Molto Bassa' END")


_ZSQL = f"({SCORE_B} + " + " + ".join(f"{c} * {w}" for c, w in SCORE_W) + ")"
_PSQL = f"(1.0 / (1.0 + EXP(-{_ZSQL})))"


@query("g03_linear_scorer",
       f"SELECT {_conf_sql(_PSQL)} AS confidence, CASE WHEN {_PSQL} >= 0.5 THEN 'Maligno' ELSE 'Benigno' END AS prediction_label, "
       f"COUNT(*) AS n, {R6(f'AVG({_PSQL})')} AS mean_probability FROM lineitem GROUP BY 1, 2")
def g03(spark, sf):
    s = SC.score_linear(tbl(spark, sf, "lineitem"), _WMAP, SCORE_B)
    return rounded(s.groupBy("confidence", "prediction_label").agg(
        F.count(F.lit(1)).alias("n"), F.avg("probability").alias("mean_probability")))


def _records(spark, sf):
    li = tbl(spark, sf, "lineitem")
    full = F.create_map(F.lit("l_quantity"), F.col("l_quantity"), F.lit("l_discount"), F.col("l_discount"),
                        F.lit("l_tax"), F.col("l_tax"))
    part = F.create_map(F.lit("l_quantity"), F.col("l_quantity"), F.lit("l_discount"), F.col("l_discount"))
    return li.select(F.col("l_orderkey").alias("rid"),
                     F.when(F.col("l_orderkey") % 13 == 0, part).otherwise(full).alias("record"))


@query("g02_score_records",
       "WITH r AS (SELECT l_orderkey % 13 = 0 AS bad, "
       f"{_PSQL} AS p FROM lineitem) "
       f"SELECT CASE WHEN bad THEN NULL ELSE {_conf_sql('p')} END AS confidence, "
       "CASE WHEN bad THEN NULL WHEN p >= 0.5 THEN 'Maligno' ELSE 'Benigno' END AS prediction_label, "
       "CASE WHEN bad THEN 'missing features: l_tax' END AS error, COUNT(*) AS n, "
       f"{R6('SUM(CASE WHEN bad THEN NULL ELSE p END)', 4)} AS total_probability FROM r GROUP BY 1, 2, 3")
def g02(spark, sf):
    out = SC.score_records(_records(spark, sf), "record", _WMAP, SCORE_B, id_col="rid")
    return rounded(out.groupBy("confidence", "prediction_label", "error").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("probability"), 4).alias("total_probability")))


def _requests(spark, sf):
    """One request per order: its lines as an array of records, every third line without its tax."""
    li = tbl(spark, sf, "lineitem")
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax")))
    two = lambda x: (F.lit("l_quantity"), x["l_quantity"], F.lit("l_discount"), x["l_discount"])
    record = lambda x: F.when(x["l_linenumber"] % 3 == 0, F.create_map(*two(x))).otherwise(
        F.create_map(*two(x), F.lit("l_tax"), x["l_tax"]))
    return li.groupBy("l_orderkey").agg(F.transform(lines, record).alias("records"))


_REQUEST_SQL = ("r AS (SELECT l_orderkey, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, "
                f"l_discount, l_tax) - 1 AS pos, l_linenumber % 3 = 0 AS bad, {_PSQL} AS p FROM lineitem)")


@query("g02_score_request",
       f"WITH {_REQUEST_SQL} SELECT l_orderkey, CAST(pos AS INTEGER) AS id, CASE WHEN NOT bad THEN CAST(p >= 0.5 AS INTEGER) END AS prediction, "
       f"{R6('CASE WHEN NOT bad THEN p END')} AS probability, CASE WHEN bad THEN 'missing features: l_tax' END AS error FROM r")
def g02r(spark, sf):
    out = SC.score_batch(_requests(spark, sf), "records", "l_orderkey", _WMAP, SCORE_B)
    return rounded(out.select("l_orderkey", "id", "prediction", "probability", "error"))


@query("g02_request_summary",
       f"WITH {_REQUEST_SQL} SELECT l_orderkey, COUNT(*) AS total, COUNT(*) FILTER (WHERE NOT bad) AS successful, COUNT(*) FILTER (WHERE bad) AS failed "
       "FROM r GROUP BY l_orderkey")
def g02s(spark, sf):
    requests = _requests(spark, sf)
    return SC.batch_summary(requests, "records", "l_orderkey", SC.score_batch(requests, "records", "l_orderkey", _WMAP, SCORE_B))


@query("g04_prediction_log_profile",
       f"{W} SELECT {_conf_sql('score')} AS confidence, COUNT(*) AS n, {R6('AVG(score)')} AS mean_probability, "
       f"{R6('AVG(CAST(prediction AS DOUBLE))')} AS positive_share FROM ls GROUP BY 1")
def g04(spark, sf):
    log = SC.prediction_log(li_scored(spark, sf), ["l_quantity", "l_discount", "l_tax"], "score", "prediction")
    return rounded(SC.log_profile(log))
