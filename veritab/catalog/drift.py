"""Drift: D1-D3, D5-D9 (D4 lives with the monitoring run)."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritab.catalog.base import (LD_NUMERIC, LI_CATEGORICAL, LI_NUMERIC, SQL_LI_DRIFTED,
                                  SQL_LI_SCORED, SQL_LI_SIDES, li_drifted, li_scored, lineitem_sides, query, rounded, sql_chi2_sf,
                                  sql_ks_pvalue, sql_melt, sql_round, sql_union, tbl)
from veritab.operators import drift as D
from veritab.operators import rules as R

R6 = sql_round


def _melt_sides(src, cols):
    return sql_union([f"SELECT side, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src} WHERE {c} IS NOT NULL"
                      for c in cols])


def _ecdf_cte(src, cols):
    return (f"m AS ({_melt_sides(src, cols)}), "
            "c AS (SELECT feature, value, SUM(CASE WHEN side = 'reference' THEN 1 ELSE 0 END) AS nr, "
            "SUM(CASE WHEN side = 'current' THEN 1 ELSE 0 END) AS nc FROM m GROUP BY feature, value), "
            "e AS (SELECT feature, value, LEAD(value) OVER (PARTITION BY feature ORDER BY value) AS nxt, "
            "SUM(nr) OVER (PARTITION BY feature) AS tr, SUM(nc) OVER (PARTITION BY feature) AS tc, "
            "SUM(nr) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 1.0 "
            "/ SUM(nr) OVER (PARTITION BY feature) AS fr, "
            "SUM(nc) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 1.0 "
            "/ SUM(nc) OVER (PARTITION BY feature) AS fc FROM c), "
            "ks AS (SELECT feature, CAST(MAX(tr) AS BIGINT) AS n_reference, CAST(MAX(tc) AS BIGINT) AS n_current, "
            "MAX(ABS(fr - fc)) AS statistic, SUM(ABS(fr - fc) * COALESCE(nxt - value, 0)) AS wasserstein "
            "FROM e GROUP BY feature), "
            f"ksp AS (SELECT *, {sql_ks_pvalue('statistic', 'n_reference', 'n_current')} AS p_value FROM ks)")


def _chi_cte(src, cols, name="chi"):
    melt = sql_union([f"SELECT side, '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM {src} WHERE {c} IS NOT NULL"
                      for c in cols])
    return (f"{name}_m AS ({melt}), "
            f"{name}_c AS (SELECT feature, value, COUNT(*) FILTER (WHERE side = 'reference') AS o_r, "
            f"COUNT(*) FILTER (WHERE side = 'current') AS o_c FROM {name}_m GROUP BY feature, value), "
            f"{name}_t AS (SELECT feature, SUM(o_r) AS n_r, SUM(o_c) AS n_c, COUNT(*) AS k FROM {name}_c GROUP BY feature), "
            f"{name}_s AS (SELECT c.feature, CAST(MAX(n_r) AS BIGINT) AS n_reference, CAST(MAX(n_c) AS BIGINT) AS n_current, "
            f"CAST(MAX(k) - 1 AS BIGINT) AS dof, "
            "SUM(CASE WHEN (o_r + o_c) * n_r * 1.0 / (n_r + n_c) > 0 THEN POWER(o_r - (o_r + o_c) * n_r * 1.0 / (n_r + n_c), 2) "
            "/ ((o_r + o_c) * n_r * 1.0 / (n_r + n_c)) ELSE 0 END + "
            "CASE WHEN (o_r + o_c) * n_c * 1.0 / (n_r + n_c) > 0 THEN POWER(o_c - (o_r + o_c) * n_c * 1.0 / (n_r + n_c), 2) "
            "/ ((o_r + o_c) * n_c * 1.0 / (n_r + n_c)) ELSE 0 END) AS statistic, "
            "SUM(ABS(o_r * 1.0 / n_r - o_c * 1.0 / n_c)) / 2 AS tv_distance "
            f"FROM {name}_c c JOIN {name}_t t ON c.feature = t.feature GROUP BY c.feature), "
            f"{name} AS (SELECT *, {sql_chi2_sf('statistic', 'dof')} AS p_value FROM {name}_s)")


_KS_SQL = (f"WITH {SQL_LI_SIDES}, {_ecdf_cte('li', LI_NUMERIC)} SELECT feature, n_reference, n_current, "
           f"{R6('statistic')} AS statistic, {R6('p_value')} AS p_value, p_value < 0.05 AS drifted FROM ksp")


@query("d01_ks_two_sample", _KS_SQL)
def d01(spark, sf):
    return rounded(D.ks_two_sample(lineitem_sides(spark, sf), LI_NUMERIC))


@query("d02_chi_square",
       f"WITH {SQL_LI_SIDES}, {_chi_cte('li', LI_CATEGORICAL)} SELECT feature, n_reference, n_current, dof, "
       f"{R6('statistic')} AS statistic, {R6('p_value')} AS p_value, p_value < 0.05 AS drifted, "
       f"{R6('tv_distance')} AS tv_distance FROM chi")
def d02(spark, sf):
    return rounded(D.chi_square(lineitem_sides(spark, sf), LI_CATEGORICAL))


_PSI_CTE = (
    f"pm AS ({_melt_sides('li', LI_NUMERIC)}), "
    "edges AS (SELECT feature, QUANTILE_CONT(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q "
    "FROM pm WHERE side = 'reference' GROUP BY feature), "
    "pb AS (SELECT pm.feature, side, CAST(list_sum(list_transform(q, lambda e: CASE WHEN value > e THEN 1 ELSE 0 END)) AS INTEGER) AS bin "
    "FROM pm JOIN edges ON pm.feature = edges.feature), "
    "pc AS (SELECT feature, bin, COUNT(*) FILTER (WHERE side = 'reference') AS c_r, "
    "COUNT(*) FILTER (WHERE side = 'current') AS c_c FROM pb GROUP BY feature, bin), "
    "pg AS (SELECT e.feature, b.bin, COALESCE(c_r, 0) AS c_r, COALESCE(c_c, 0) AS c_c FROM edges e "
    "CROSS JOIN range(0, 10) b(bin) LEFT JOIN pc ON pc.feature = e.feature AND pc.bin = b.bin), "
    "ps AS (SELECT feature, GREATEST(c_r * 1.0 / SUM(c_r) OVER (PARTITION BY feature), 0.0001) AS r, "
    "GREATEST(c_c * 1.0 / SUM(c_c) OVER (PARTITION BY feature), 0.0001) AS c FROM pg), "
    "psi AS (SELECT feature, SUM((c - r) * LN(c / r)) AS psi, SUM(r * LN(r / c)) AS kl_divergence FROM ps GROUP BY feature), "
    "sd AS (SELECT feature, STDDEV_POP(value) AS sd FROM pm WHERE side = 'reference' GROUP BY feature)")


@query("d03_psi_kl_wasserstein",
       f"WITH {SQL_LI_SIDES}, {_ecdf_cte('li', LI_NUMERIC)}, {_PSI_CTE} "
       f"SELECT psi.feature, {R6('psi')} AS psi, {R6('kl_divergence')} AS kl_divergence, "
       f"{R6('wasserstein')} AS wasserstein, {R6('CASE WHEN sd > 0 THEN wasserstein / sd END')} AS wasserstein_normed, "
       "psi > 0.25 AS psi_drift, kl_divergence > 0.1 AS kl_drift, "
       "(CASE WHEN sd > 0 THEN wasserstein / sd END) > 0.1 AS wasserstein_drift "
       "FROM psi JOIN ks ON psi.feature = ks.feature LEFT JOIN sd ON sd.feature = psi.feature")
def d03(spark, sf):
    return rounded(D.distances(lineitem_sides(spark, sf), LI_NUMERIC))


@query("d05_cv_score",
       sql_union([f"SELECT '{c}' AS feature, {R6(f'STDDEV_SAMP({c}) / AVG({c})')} AS cv, "
                  f"{R6(f'CASE WHEN COUNT({c}) > 1 THEN LEAST(1.0, STDDEV_SAMP({c}) / AVG({c}) * 10) ELSE 0 END')} AS drift_score, "
                  f"CASE WHEN (CASE WHEN COUNT({c}) > 1 THEN LEAST(1.0, STDDEV_SAMP({c}) / AVG({c}) * 10) ELSE 0 END) < 0.1 THEN 'stable' "
                  f"WHEN (CASE WHEN COUNT({c}) > 1 THEN LEAST(1.0, STDDEV_SAMP({c}) / AVG({c}) * 10) ELSE 0 END) < 0.3 THEN 'minor' "
                  "ELSE 'high' END AS status FROM orders" for c in ["o_totalprice"]]
                 + [f"SELECT 'c_acctbal', {R6('STDDEV_SAMP(c_acctbal) / AVG(c_acctbal)')}, "
                    f"{R6('LEAST(1.0, STDDEV_SAMP(c_acctbal) / AVG(c_acctbal) * 10)')}, "
                    "CASE WHEN LEAST(1.0, STDDEV_SAMP(c_acctbal) / AVG(c_acctbal) * 10) < 0.1 THEN 'stable' "
                    "WHEN LEAST(1.0, STDDEV_SAMP(c_acctbal) / AVG(c_acctbal) * 10) < 0.3 THEN 'minor' ELSE 'high' END FROM customer"]))
def d05(spark, sf):
    a = D.cv_score(tbl(spark, sf, "orders"), ["o_totalprice"])
    b = D.cv_score(tbl(spark, sf, "customer"), ["c_acctbal"])
    return rounded(a.unionByName(b))


_COLDRIFT_CTE = (f"{SQL_LI_DRIFTED}, {_ecdf_cte('ld', LD_NUMERIC)}, {_chi_cte('ld', LI_CATEGORICAL)}, "
                 "cd AS (SELECT feature, 'ks' AS test, statistic, p_value, statistic AS drift_score, p_value < 0.05 AS drifted FROM ksp "
                 "UNION ALL SELECT feature, 'chi_square', statistic, p_value, tv_distance, p_value < 0.05 FROM chi)")


@query("d06_dataset_drift",
       f"WITH {_COLDRIFT_CTE} SELECT COUNT(*) AS n_columns, COUNT(*) FILTER (WHERE drifted) AS n_drifted, "
       f"{R6('COUNT(*) FILTER (WHERE drifted) * 1.0 / COUNT(*)')} AS drift_share, "
       "COUNT(*) FILTER (WHERE drifted) * 1.0 / COUNT(*) > 0.3 AS dataset_drift FROM cd")
def d06(spark, sf):
    t = li_drifted(spark, sf)
    return rounded(D.dataset_drift(D.column_drift(t, LD_NUMERIC, LI_CATEGORICAL)))


@query("d06_column_drift_table",
       f"WITH {_COLDRIFT_CTE} SELECT feature, test, {R6('statistic')} AS statistic, {R6('p_value')} AS p_value, "
       f"{R6('drift_score')} AS drift_score, drifted FROM cd")
def d06b(spark, sf):
    return rounded(D.column_drift(li_drifted(spark, sf), LD_NUMERIC, LI_CATEGORICAL))


@query("d07_drift_alerts",
       f"WITH {_COLDRIFT_CTE}, s AS (SELECT COUNT(*) FILTER (WHERE drifted) * 1.0 / COUNT(*) AS share FROM cd), "
       "mt AS (SELECT NULL::VARCHAR AS scope, 'dataset_drift' AS metric, CAST(share > 0.3 AS DOUBLE) AS value FROM s "
       "UNION ALL SELECT NULL, 'drift_share', share FROM s UNION ALL SELECT NULL, 'drifted_feature_share', share FROM s "
       "UNION ALL SELECT feature, 'column_drift_score', drift_score FROM cd WHERE drifted), "
       "r AS (SELECT * FROM (VALUES ('dataset_drift', 'dataset_drift', '>=', 1.0, 'Dataset drift detected: '), "
       "('drift_share_high', 'drift_share', '>', 0.05, 'High drift share: '), "
       "('too_many_drifted_columns', 'drifted_feature_share', '>', 0.3, 'Too many drifted columns: '), "
       "('column_drift_significant', 'column_drift_score', '>', 0.5, 'Significant drift in column: ')) r(rule, metric, op, lim, msg)) "
       f"SELECT rule, scope, mt.metric, {R6('value')} AS value, {R6('lim')} AS \"limit\", "
       "msg || COALESCE(scope, '') || ' ' || printf('%.2f', value) AS message FROM mt JOIN r ON mt.metric = r.metric "
       "WHERE (op = '>=' AND value >= lim) OR (op = '>' AND value > lim)")
def d07(spark, sf):
    t = li_drifted(spark, sf)
    cols = D.column_drift(t, LD_NUMERIC, LI_CATEGORICAL)
    m = D.drift_metrics_long(cols, D.dataset_drift(cols))
    return rounded(R.apply_rules(m, R.rule_table(spark, R.DRIFT_RULES)))


@query("d08_drift_causes",
       f"WITH {_COLDRIFT_CTE}, mean AS (SELECT AVG(drift_score) AS a FROM cd WHERE drifted) "
       f"SELECT feature, {R6('drift_score')} AS drift_score, {R6('a')} AS mean_drifted_score FROM cd, mean "
       "WHERE drifted AND drift_score > 0.3")
def d08(spark, sf):
    return rounded(D.drift_causes(D.column_drift(li_drifted(spark, sf), LD_NUMERIC, LI_CATEGORICAL)))


@query("d09_target_prediction_drift",
       f"WITH {SQL_LI_SCORED}, {_chi_cte('ls', ['label'])}, {_ecdf_cte('ls', ['score'])} "
       f"SELECT 'target_drift' AS kind, feature, {R6('statistic')} AS statistic, {R6('p_value')} AS p_value, "
       "p_value < 0.05 AS drifted FROM chi UNION ALL "
       f"SELECT 'prediction_drift', feature, {R6('statistic')}, {R6('p_value')}, p_value < 0.05 FROM ksp")
def d09(spark, sf):
    return rounded(D.target_prediction_drift(li_scored(spark, sf), "label", "score"))
