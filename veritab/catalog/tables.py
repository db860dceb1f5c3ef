"""Run log (X1, X2), joins (J1, J2, J4, J5) and linear-scorer permutation importance."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from veritab.catalog.base import (LI_KEY, LI_NUMERIC, SCORE_B, SCORE_W, SQL_LI_SCORED, SQL_LI_SIDES,
                                  li_scored, lineitem_sides, query, rounded, sql_round, sql_union, tbl)
from veritab.catalog.evaluation import BOOT_B, SQL_DRAWS
from veritab.operators.models import importance_summary
from veritab.operators import evaluate as EV
from veritab.operators import features as FE
from veritab.operators import resample as RS
from veritab.operators import runs as RU
from veritab.operators.profile import melt
from veritab.session import checkpoint_dir

R6 = sql_round
_MD5F = "md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, '42'))"
_RUNS_SQL = (f"{SQL_LI_SCORED}, fo AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY label ORDER BY {_MD5F}) - 1) % 5 AS fold FROM ls), "
             "c AS (SELECT 'scorer_' || l_linestatus AS model_name, CAST(fold + 1 AS INTEGER) AS version, "
             "SUM(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp, "
             "SUM(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS fp, "
             "SUM(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS fn, "
             "SUM(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS tn FROM fo GROUP BY 1, 2), "
             "m AS (SELECT model_name, version, (tp + tn) * 1.0 / (tp + fp + fn + tn) AS accuracy, "
             "CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0 END AS precision, "
             "CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0 END AS recall FROM c), "
             "mf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m)")


def _runs(spark, sf):
    f = FE.stratified_folds(li_scored(spark, sf), "label", LI_KEY, 5, 42)
    f = f.withColumn("model_name", F.concat(F.lit("scorer_"), F.col("l_linestatus"))) \
        .withColumn("version", F.col("fold") + 1)
    wide = EV.classification_metrics(f, "label", "prediction", ["model_name", "version"])
    long = EV.metrics_long(wide, ["model_name", "version"])
    return RU.run_records(long, "model_name", "version", params={"threshold": "0.5"},
                          tags={"source": "lineitem"})


@query("x01_run_log",
       f"WITH {_RUNS_SQL} SELECT model_name, version, x.metric, {R6('x.value')} AS value FROM mf, "
       "LATERAL (VALUES ('accuracy', accuracy), ('precision', precision), ('recall', recall), ('f1', f1)) x(metric, value)")
def x01(spark, sf):
    path = f"{checkpoint_dir(spark).rstrip('/')}/runs/{uuid.uuid4().hex}"
    RU.append_runs(_runs(spark, sf), path)
    back = spark.read.parquet(path)
    return rounded(RU.metrics_of(back).select("model_name", F.col("version").cast("int").alias("version"),
                                              "metric", "value"))


@query("x02_best_run",
       f"WITH {_RUNS_SQL} SELECT model_name, version, {R6('recall')} AS recall FROM mf "
       "ORDER BY recall DESC, version, model_name LIMIT 1")
def x02(spark, sf):
    return rounded(RU.best_run(_runs(spark, sf), "recall"))


@query("x02_latest_versions",
       f"WITH {_RUNS_SQL} SELECT model_name, version, {R6('accuracy')} AS accuracy FROM mf "
       "WHERE (model_name, version) IN (SELECT (model_name, MAX(version)) FROM mf GROUP BY model_name)")
def x02b(spark, sf):
    lv = RU.latest_versions(_runs(spark, sf))
    return rounded(lv.select("model_name", "version", F.col("metrics")["accuracy"].alias("accuracy")))


@query("x02_list_runs", f"WITH {_RUNS_SQL} SELECT model_name, version FROM mf")
def x02c(spark, sf):
    return RU.list_runs(_runs(spark, sf))


@query("j01_pair_sides",
       f"WITH {SQL_LI_SIDES}, a AS (" + sql_union(
           [f"SELECT '{c}' AS feature, AVG(CASE WHEN side = 'reference' THEN {c} END) AS r, "
            f"AVG(CASE WHEN side = 'current' THEN {c} END) AS c FROM li" for c in LI_NUMERIC])
       + f") SELECT feature, 'mean' AS metric, {R6('r')} AS reference, {R6('c')} AS current, {R6('c - r')} AS delta, "
       f"{R6('CASE WHEN r > 0 THEN (c - r) / r END')} AS relative FROM a")
def j01(spark, sf):
    long = melt(lineitem_sides(spark, sf), LI_NUMERIC, by=["side"]).groupBy("side", "feature") \
        .agg(F.avg("value").alias("value")).withColumn("metric", F.lit("mean"))
    return rounded(EV.pair_sides(long))


_PERM_FEATS = [c for c, _ in SCORE_W]
_PERM_REPEATS = 10


def _perm_sql():
    jobs = ", ".join(f"('{f}', {r})" for f in _PERM_FEATS for r in range(_PERM_REPEATS))
    case = "CASE feature " + " ".join(f"WHEN '{f}' THEN {f}" for f in _PERM_FEATS) + " END"
    wcase = "CASE feature " + " ".join(f"WHEN '{f}' THEN {w}" for f, w in SCORE_W) + " END"
    z = f"({SCORE_B} + " + " + ".join(f"{c} * {w}" for c, w in SCORE_W) + ")"
    return (f"{SQL_LI_SCORED}, x AS (SELECT ls.*, j.feature, j.repeat, {z} AS z, {case} AS xv FROM ls, (VALUES {jobs}) j(feature, repeat)), "
            f"own AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY feature, repeat ORDER BY {_MD5F}) AS r FROM x), "
            "src AS (SELECT feature, repeat, xv AS permuted, ROW_NUMBER() OVER (PARTITION BY feature, repeat ORDER BY "
            "md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, feature, repeat, '42'))) AS r FROM x), "
            f"p AS (SELECT own.feature, own.repeat, label, CAST(ROUND(1.0 / (1.0 + EXP(-(z + {wcase.replace('feature', 'own.feature')} * (permuted - xv)))), 9) >= 0.5 AS INTEGER) AS pred "
            "FROM own JOIN src ON own.feature = src.feature AND own.repeat = src.repeat AND own.r = src.r), "
            "pr AS (SELECT feature, repeat, CASE WHEN SUM(label) > 0 THEN SUM(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) * 1.0 / SUM(label) ELSE 0 END AS recall FROM p GROUP BY 1, 2), "
            "b AS (SELECT SUM(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) * 1.0 / SUM(label) AS base FROM ls), "
            "pi AS (SELECT feature, AVG(base - recall) AS importance_mean, STDDEV_POP(base - recall) AS importance_std FROM pr, b GROUP BY feature)")


@query("m09_linear_permutation_importance",
       f"WITH {_perm_sql()} SELECT feature, {R6('importance_mean')} AS importance_mean, "
       f"{R6('importance_std')} AS importance_std FROM pi")
def m09l(spark, sf):
    return rounded(EV.linear_permutation_importance(li_scored(spark, sf), dict(SCORE_W), SCORE_B, "label",
                                                    LI_KEY, _PERM_REPEATS, 42))


@query("j02_combine_importance",
       f"WITH {_perm_sql()}, co AS (SELECT * FROM (VALUES " + ", ".join(f"('{f}', {w})" for f, w in SCORE_W)
       + ") v(feature, coefficient)), jj AS (SELECT co.feature, coefficient, importance_mean FROM co JOIN pi ON co.feature = pi.feature) "
       f"SELECT feature, {R6('coefficient')} AS coefficient, {R6('importance_mean')} AS importance_mean, "
       f"{R6('ABS(coefficient) / MAX(ABS(coefficient)) OVER ()')} AS coefficient_norm, "
       f"{R6('importance_mean / MAX(importance_mean) OVER ()')} AS permutation_norm FROM jj")
def j02(spark, sf):
    perm = EV.linear_permutation_importance(li_scored(spark, sf), dict(SCORE_W), SCORE_B, "label", LI_KEY,
                                            _PERM_REPEATS, 42)
    coef = spark.createDataFrame([(f, float(w)) for f, w in SCORE_W], "feature string, coefficient double")
    return rounded(EV.combine_importance(coef, perm))


@query("m25_linear_importance_summary",
       f"WITH {_perm_sql()}, co AS (SELECT * FROM (VALUES " + ", ".join(f"('{f}', {w}, {i})" for i, (f, w) in enumerate(SCORE_W))
       + ") v(feature, coefficient, i)), "
       f"cc AS (SELECT 'coefficient' AS kind, feature, {R6('ABS(coefficient)')} AS score FROM co ORDER BY ABS(coefficient) DESC, feature LIMIT 2), "
       f"pp AS (SELECT 'permutation' AS kind, 'f' || i AS feature, {R6('importance_mean')} AS score FROM pi JOIN co ON pi.feature = co.feature "
       "ORDER BY importance_mean DESC, i LIMIT 2) SELECT * FROM cc UNION ALL SELECT * FROM pp")
def m25l(spark, sf):
    perm = EV.linear_permutation_importance(li_scored(spark, sf), dict(SCORE_W), SCORE_B, "label", LI_KEY, _PERM_REPEATS, 42)
    coef = spark.createDataFrame([(f, float(w), abs(float(w)), i) for i, (f, w) in enumerate(SCORE_W)],
                                 "feature string, coefficient double, abs_coefficient double, feature_index int")
    perm = perm.join(coef.select("feature", "feature_index"), "feature")
    return rounded(importance_summary(coef.drop("feature_index"), perm, 2))


@query("j04_permutation_pairs",
       f"WITH {_perm_sql()} SELECT own.feature, own.repeat AS repeat, COUNT(*) AS n, "
       f"{R6('SUM(permuted)', 4)} AS permuted_sum, {R6('SUM(xv)', 4)} AS original_sum, "
       "COUNT(*) FILTER (WHERE permuted <> xv) AS changed FROM own JOIN src ON own.feature = src.feature "
       "AND own.repeat = src.repeat AND own.r = src.r GROUP BY 1, 2")
def j04(spark, sf):
    p = EV.permutation_pairs(li_scored(spark, sf), _PERM_FEATS, LI_KEY, _PERM_REPEATS, 42)
    return rounded(p.groupBy("feature", F.col("repeat").cast("int").alias("repeat")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("permuted"), 4).alias("permuted_sum"),
        F.round(F.sum("original"), 4).alias("original_sum"),
        F.count_if(F.col("permuted") != F.col("original")).alias("changed")))


@query("j05_bootstrap_expansion",
       f"WITH {SQL_LI_SCORED}, {SQL_DRAWS} SELECT CAST(replicate AS INTEGER) AS replicate, COUNT(*) FILTER (WHERE bw > 0) AS cells_kept, "
       "CAST(SUM(bw) AS BIGINT) AS total_weight FROM bw GROUP BY replicate")
def j05(spark, sf):
    b = RS.weights(RS.cells(li_scored(spark, sf), "label", "prediction", "score"), BOOT_B, 42)
    return b.groupBy("replicate").agg(F.count_if(F.col("weight") > 0).alias("cells_kept"),
                                      F.sum("weight").cast("long").alias("total_weight"))
