"""Monitoring runs: Q4 quality percent, D4 CV drift, B1 combined run."""

from __future__ import annotations

from veritab.catalog.base import (LI_NUMERIC, SQL_LI_SIDES, lineitem_sides, query, rounded,
                                  sql_round, sql_union)
from veritab.operators.drift import cv_drift
from veritab.operators.quality import quality_percent
from veritab.plans.monitor import run_checks
from veritab.roles import LINEITEM

_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _sql_q4() -> str:
    nulls = " + ".join(f"(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in _LI_COLS)
    pct = f"(nulls * 1.0 / (n * {len(_LI_COLS)}) * 100)"
    score = f"GREATEST(0.0, 100.0 - {pct})"
    band = f"CASE WHEN {score} >= 90 THEN 'good' WHEN {score} >= 70 THEN 'warning' ELSE 'critical' END"
    parts = []
    for metric, val, st in [("total_rows", "n", "NULL"), ("missing_percentage", pct, "NULL"),
                            ("quality_score", score, band), ("threshold", "10.0", "NULL")]:
        parts.append(f"SELECT 'data_quality' AS \"check\", side, CAST(NULL AS VARCHAR) AS feature, "
                     f"'{metric}' AS metric, {sql_round(val)} AS value, CAST({st} AS VARCHAR) AS status FROM q")
    return (f"q AS (SELECT s.side, COALESCE(n, 0) AS n, COALESCE(nulls, 0) AS nulls FROM "
            f"(VALUES ('reference'), ('current')) s(side) LEFT JOIN "
            f"(SELECT side, COUNT(*) AS n, SUM({nulls}) AS nulls FROM li GROUP BY side) a ON a.side = s.side)",
            sql_union(parts))


def _sql_d4() -> tuple[str, str]:
    stats = []
    for f in LI_NUMERIC:
        stats.append(
            f"SELECT '{f}' AS feature, "
            f"COUNT(CASE WHEN side='reference' THEN {f} END) AS nr, COUNT(CASE WHEN side='current' THEN {f} END) AS nc, "
            f"STDDEV_SAMP(CASE WHEN side='reference' THEN {f} END) / AVG(CASE WHEN side='reference' THEN {f} END) AS cvr, "
            f"STDDEV_SAMP(CASE WHEN side='current' THEN {f} END) / AVG(CASE WHEN side='current' THEN {f} END) AS cvc "
            f"FROM li")
    sc = ("CASE WHEN nr > 1 AND nc > 1 THEN LEAST(1.0, COALESCE(ABS(cvc - cvr) / GREATEST(cvr, 0.001), 0.0)) "
          "ELSE 0.0 END")
    ctes = f"cv AS ({sql_union(stats)}), sc AS (SELECT *, {sc} AS score FROM cv)"
    avg_band = ("CASE WHEN a < 0.1 THEN 'stable' WHEN a < 0.3 THEN 'minor' ELSE 'high' END")
    body = sql_union([
        f"SELECT 'drift' AS \"check\", 'reference' AS side, feature, 'cv' AS metric, {sql_round('cvr')} AS value, CAST(NULL AS VARCHAR) AS status FROM sc",
        f"SELECT 'drift', 'current', feature, 'cv', {sql_round('cvc')}, NULL FROM sc",
        f"SELECT 'drift', 'both', feature, 'drift_score', {sql_round('score')}, NULL FROM sc",
        f"SELECT 'drift', 'both', NULL, 'average_drift', {sql_round('a')}, {avg_band} FROM (SELECT AVG(score) AS a FROM sc)",
        f"SELECT 'drift', 'both', NULL, 'threshold', 0.25, NULL",
    ])
    return ctes, body


_Q4_CTE, _Q4_BODY = _sql_q4()
_D4_CTE, _D4_BODY = _sql_d4()


@query("q04_quality_percent", f"WITH {SQL_LI_SIDES}, {_Q4_CTE}\n{_Q4_BODY}")
def q04_quality_percent(spark, sf):
    return rounded(quality_percent(lineitem_sides(spark, sf), side_col="side"))


@query("d04_cv_drift", f"WITH {SQL_LI_SIDES}, {_D4_CTE}\n{_D4_BODY}")
def d04_cv_drift(spark, sf):
    return rounded(cv_drift(lineitem_sides(spark, sf), LI_NUMERIC))


@query("b01_monitor_run",
       f"WITH {SQL_LI_SIDES}, {_Q4_CTE}, {_D4_CTE}\n{_Q4_BODY}\nUNION ALL\n{_D4_BODY}")
def b01_monitor_run(spark, sf):
    return rounded(run_checks(lineitem_sides(spark, sf), LINEITEM))


REGISTRY_SQL = {"b01_monitor_run": f"WITH {SQL_LI_SIDES}, {_Q4_CTE}, {_D4_CTE}\n{_Q4_BODY}\nUNION ALL\n{_D4_BODY}"}
