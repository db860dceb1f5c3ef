"""Sources and sinks round trips (S1-S10), composed reports (A22, B2), the preprocessing
flow (E8) and the required-column check (W4)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from veritab.catalog.base import (LI_KEY, LI_NUMERIC, LP_NUMERIC, SQL_LI_NULLS, SQL_LI_PRICED,
                                  SQL_LI_SCORED, li_priced, li_scored, li_with_nulls, lineitem_sides,
                                  query, rounded, sql_round, sql_union, tbl)
from veritab.catalog import features as CF
from veritab.catalog import monitoring as MON
from veritab.catalog import profiles as PRO
from veritab.operators import evaluate as EV
from veritab.operators import features as FE
from veritab.operators import profile as P
from veritab.operators import quality as Q
from veritab.operators import rules as R
from veritab.operators.report import row, rows_from
from veritab.plans.eda import eda_report
from veritab.plans.monitor import run_checks
from veritab.plans.preprocess import preprocess
from veritab.roles import LINEITEM, Roles
from veritab.session import checkpoint_dir
from veritab.sources import io as IO

R6 = sql_round


def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/io/{name}-{uuid.uuid4().hex}"


@query("s01_scan_csv",
       f"SELECT COUNT(*) AS n, {R6('SUM(l_quantity)')} AS quantity_sum, {R6('SUM(l_extendedprice)', 2)} AS price_sum, "
       f"{R6('SUM(l_discount)', 4)} AS discount_sum, {R6('SUM(l_tax)', 4)} AS tax_sum, CAST(SUM(l_orderkey) AS BIGINT) AS orders, "
       "CAST(SUM(l_partkey) AS BIGINT) AS parts, CAST(SUM(l_suppkey) AS BIGINT) AS suppliers, "
       "CAST(SUM(l_linenumber) AS BIGINT) AS lines, COUNT(DISTINCT l_returnflag) AS flags, "
       "COUNT(DISTINCT l_linestatus) AS statuses, COUNT(DISTINCT l_shipdate) AS days FROM lineitem")
def s01(spark, sf):
    path = _scratch(spark, "csv")
    tbl(spark, sf, "lineitem").write.option("header", "true").csv(path)
    back = IO.read_csv(spark, path)
    return rounded(back.agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity_sum"),
                            F.round(F.sum("l_extendedprice"), 2).alias("price_sum"),
                            F.round(F.sum("l_discount"), 4).alias("discount_sum"), F.round(F.sum("l_tax"), 4).alias("tax_sum"),
                            *[F.sum(c).cast("long").alias(n) for c, n in (("l_orderkey", "orders"), ("l_partkey", "parts"),
                                                                          ("l_suppkey", "suppliers"), ("l_linenumber", "lines"))],
                            F.count_distinct("l_returnflag").alias("flags"), F.count_distinct("l_linestatus").alias("statuses"),
                            F.count_distinct("l_shipdate").alias("days")))


@query("s02_load_pair",
       "WITH c AS (SELECT l_returnflag AS lbl, COUNT(*) AS n_k FROM lineitem GROUP BY 1), "
       "tt AS (SELECT CEIL(SUM(n_k) * CAST(0.2 AS DOUBLE)) AS t FROM c) "
       "SELECT 'test' AS part, CAST(t AS BIGINT) AS n, 4 AS n_features FROM tt UNION ALL "
       "SELECT 'train', (SELECT COUNT(*) FROM lineitem) - CAST(t AS BIGINT), 4 FROM tt")
def s02(spark, sf):
    s = FE.stratified_split(tbl(spark, sf, "lineitem").select(*LI_KEY[:1], "l_returnflag", "l_quantity", "l_discount",
                                                               "l_tax", *LI_KEY[1:]),
                            "l_returnflag", LI_KEY, 0.2, 42)
    base = _scratch(spark, "pair")
    cols = ["l_quantity", "l_discount", "l_tax", "l_orderkey", "l_returnflag"]
    IO.write_table(s.where("split = 'train'").select(*cols), f"{base}/train")
    IO.write_table(s.where("split = 'test'").select(*cols), f"{base}/test")
    train, test, feats = IO.load_pair(spark, f"{base}/train", f"{base}/test", "l_returnflag")
    return train.agg(F.count(F.lit(1)).alias("n")).select(F.lit("train").alias("part"), "n", F.lit(len(feats)).alias("n_features")) \
        .unionByName(test.agg(F.count(F.lit(1)).alias("n")).select(F.lit("test").alias("part"), "n",
                                                                   F.lit(len(feats)).alias("n_features")))


@query("s03_resolve_read",
       "SELECT 'present' AS kind, TRUE AS found, COUNT(*) AS n FROM lineitem UNION ALL SELECT 'missing', FALSE, 0")
def s03(spark, sf):
    present = IO.read_if_exists(spark, IO.resolve_path(f"{sf.rstrip('/')}/lineitem.parquet", environment="local"))
    missing = IO.read_if_exists(spark, _scratch(spark, "absent"))
    a = present.agg(F.count(F.lit(1)).alias("n")).select(F.lit("present").alias("kind"), F.lit(True).alias("found"), "n")
    b = spark.range(1).select(F.lit("missing").alias("kind"), F.lit(missing is not None).alias("found"),
                              F.lit(0).cast("long").alias("n"))
    return a.unionByName(b)


@query("s04_feature_list",
       "WITH s AS (" + PRO._describe_sql("lineitem", LI_NUMERIC).replace("SELECT feature,", "SELECT feature, 1 AS one,", 1)
       + ") SELECT CAST(ROW_NUMBER() OVER (ORDER BY feature) - 1 AS INTEGER) AS position, feature FROM s")
def s04(spark, sf):
    names = P.numeric_names(tbl(spark, sf, "lineitem").select(*LI_NUMERIC))  # from the schema: no job
    path = _scratch(spark, "meta")
    IO.write_metadata(spark, {"feature_names": sorted(names), "n_features": len(names)}, path)
    feats = IO.read_feature_list(spark, path)
    return spark.createDataFrame(list(enumerate(feats)), "position int, feature string")


@query("s05_write_processed",
       f"SELECT COUNT(*) AS n, {R6('SUM(l_extendedprice)', 2)} AS price_sum FROM lineitem WHERE l_returnflag = 'R'")
def s05(spark, sf):
    path = _scratch(spark, "processed")
    IO.write_table(tbl(spark, sf, "lineitem").where("l_returnflag = 'R'"), path, partition_by=["l_linestatus"])
    back = spark.read.parquet(path)
    return rounded(back.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price_sum")))


@query("s06_write_metadata", "SELECT COUNT(*) AS n_rows, 11 AS n_columns FROM lineitem")
def s06(spark, sf):
    li = tbl(spark, sf, "lineitem")
    n = li.count()
    path = _scratch(spark, "metadata")
    IO.write_metadata(spark, {"n_rows": n, "n_columns": len(li.columns)}, path)
    back = spark.read.json(path)
    return back.select(F.col("n_rows").cast("long"), F.col("n_columns").cast("int"))


@query("s07_report_csv", PRO._describe_sql("lineitem", LI_NUMERIC))
def s07(spark, sf):
    path = _scratch(spark, "report_csv")
    IO.write_report_csv(P.describe(tbl(spark, sf, "lineitem"), LI_NUMERIC), path)
    back = IO.read_csv(spark, path)
    return rounded(back.select("feature", F.col("count").cast("long"), *[F.col(c).cast("double") for c in
                                                                          ("mean", "std", "min", "q25", "q50", "q75", "max")]))


@query("s08_report_json", MON.REGISTRY_SQL["b01_monitor_run"])
def s08(spark, sf):
    rep = run_checks(lineitem_sides(spark, sf), LINEITEM)
    path = _scratch(spark, "report_json")
    IO.report_json(rep).write.text(path)
    back = spark.read.text(path)
    schema = "array<struct<check:string,side:string,feature:string,metric:string,value:double,status:string>>"
    return rounded(back.select(F.inline(F.from_json("value", schema))))


@query("s09_prediction_log",
       f"WITH {SQL_LI_SCORED} SELECT CASE WHEN prediction = 1 THEN 'Maligno' ELSE 'Benigno' END AS prediction_label, "
       "2 * COUNT(*) AS n FROM ls GROUP BY 1")
def s09(spark, sf):
    from veritab.operators.score import prediction_log
    log = prediction_log(li_scored(spark, sf), ["l_quantity", "l_discount", "l_tax"], "score", "prediction")
    path = _scratch(spark, "predlog")
    for run in ("first", "second", "second"):  # a repeated run writes once
        IO.append_prediction_log(log, path, run)
    back = IO.read_runs(spark, path, log.schema)
    return back.groupBy("prediction_label").agg(F.count(F.lit(1)).alias("n"))


@query("s10_alert_sink",
       f"WITH {SQL_LI_SCORED}, c AS (SELECT side, SUM(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp, "
       "SUM(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS fp, SUM(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS fn, "
       "SUM(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS tn FROM ls GROUP BY side), "
       "m AS (SELECT side, (tp + tn) * 1.0 / (tp + fp + fn + tn) AS accuracy, CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0 END AS precision, "
       "CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0 END AS recall FROM c), "
       "mf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM m), "
       "ml AS (SELECT side, x.metric, x.value FROM mf, LATERAL (VALUES ('accuracy', accuracy), ('precision', precision), "
       "('recall', recall), ('f1', f1)) x(metric, value)), "
       "r AS (SELECT * FROM (VALUES ('low_accuracy', 'accuracy', 0.85), ('low_recall', 'recall', 0.9), ('low_precision', 'precision', 0.8), "
       "('low_f1', 'f1', 0.85)) r(rule, metric, lim)) "
       "SELECT 'performance' AS type, rule, COUNT(*) AS n FROM ml JOIN r ON ml.metric = r.metric WHERE value < lim GROUP BY rule")
def s10(spark, sf):
    wide = EV.classification_metrics(li_scored(spark, sf), "label", "prediction", ["side"])
    long = EV.metrics_long(wide, ["side"]).withColumnRenamed("side", "scope")
    alerts = R.apply_rules(long, R.rule_table(spark, R.PERFORMANCE_RULES[:4])) \
        .withColumn("type", F.lit("performance")).withColumn("ts", F.current_timestamp())
    path = _scratch(spark, "alerts")
    for run in ("first", "first"):  # a repeated run writes once
        IO.write_alerts(alerts, path, run)
    back = IO.read_runs(spark, path, alerts.schema)
    return back.groupBy("type", "rule").agg(F.count(F.lit(1)).alias("n"))


# ---------------- A22 EDA report ----------------
def _a22_sql():
    out_cte = (f"m AS ({sql_union([f'SELECT {chr(39)}{c}{chr(39)} AS feature, {c} AS value FROM lp' for c in LP_NUMERIC])}), "
               "f AS (SELECT feature, QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.75) AS q3 FROM m GROUP BY feature), "
               "o AS (SELECT m.feature, COUNT(*) FILTER (WHERE m.value < q1 - 1.5 * (q3 - q1) OR m.value > q3 + 1.5 * (q3 - q1)) AS n "
               "FROM m JOIN f ON m.feature = f.feature GROUP BY m.feature), "
               "tc AS (SELECT * FROM (" + sql_union([f"SELECT '{c}' AS feature, CORR({c}, CAST(target AS DOUBLE)) AS r FROM lp"
                                                    for c in LP_NUMERIC]) + ") ORDER BY r DESC NULLS LAST, feature LIMIT 5)")
    nulls = " + ".join(f"(COUNT(*) - COUNT({c}))" for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                          "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                                                          "l_linestatus", "l_shipdate", "disc_price", "charge", "target"])
    body = sql_union([
        "SELECT 'shape' AS section, 'rows' AS item, CAST(COUNT(*) AS DOUBLE) AS value FROM lp",
        "SELECT 'shape', 'columns', 14.0",
        "SELECT 'class_count', l_returnflag, CAST(COUNT(*) AS DOUBLE) FROM lp GROUP BY l_returnflag",
        f"SELECT 'class_share', l_returnflag, {R6('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()')} FROM lp GROUP BY l_returnflag",
        f"SELECT 'missing', '__total__', CAST({nulls} AS DOUBLE) FROM lp",
        "SELECT 'outliers', feature, CAST(n AS DOUBLE) FROM o",
        f"SELECT 'top_correlation', feature, {R6('r')} FROM tc",
    ])
    return f"WITH {SQL_LI_PRICED}, {out_cte}\n{body}"


@query("a22_eda_report", _a22_sql())
def a22(spark, sf):
    lp = li_priced(spark, sf)
    return rounded(eda_report(lp, "l_returnflag", F.col("target"), LP_NUMERIC, 5))


# ---------------- B2 full report: quality + drift + performance ----------------
def _b02_sql():
    perf = (f", {SQL_LI_SCORED}, pc AS (SELECT side, SUM(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp, "
            "SUM(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS fp, SUM(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS fn, "
            "SUM(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS tn FROM ls GROUP BY side), "
            "pm AS (SELECT side, (tp + tn) * 1.0 / (tp + fp + fn + tn) AS accuracy, CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0 END AS precision, "
            "CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0 END AS recall FROM pc), "
            "pf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pm)")
    head = f"WITH {MON.SQL_LI_SIDES}, {MON._Q4_CTE}, {MON._D4_CTE}"
    body = f"{MON._Q4_BODY}\nUNION ALL\n{MON._D4_BODY}"
    perf_rows = ("\nUNION ALL\nSELECT 'performance', side, NULL, x.metric, " + R6("x.value") + ", NULL FROM pf, "
                 "LATERAL (VALUES ('accuracy', accuracy), ('precision', precision), ('recall', recall), ('f1', f1)) x(metric, value)")
    return f"{head}{perf}\n{body}{perf_rows}"


@query("b02_full_report", _b02_sql())
def b02(spark, sf):
    wide = EV.classification_metrics(li_scored(spark, sf), "label", "prediction", ["side"])
    long = EV.metrics_long(wide, ["side"])
    perf = long.select(F.lit("performance").alias("check"), "side", F.lit(None).cast("string").alias("feature"),
                       "metric", "value", F.lit(None).cast("string").alias("status"))
    return rounded(run_checks(lineitem_sides(spark, sf), LINEITEM, extra=[perf]))


# ---------------- E8 preprocessing flow ----------------
_E8_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "rate_avg", "amount_max", "unit_price"]


def _e08_sql():
    """Clean, derive, encode, select by F, split and scale, each step written out in SQL."""
    kept = ", ".join(CF._KEEP)
    derived = (f"{CF._sql_mean(['l_discount', 'l_tax'])} AS rate_avg, GREATEST(l_quantity, l_extendedprice) AS amount_max, "
               "CASE WHEN l_quantity <> 0 THEN l_extendedprice / l_quantity END AS unit_price, "
               "DENSE_RANK() OVER (ORDER BY l_linestatus) - 1 AS target")
    scaled = sql_union([
        f"SELECT split, '{c}' AS feature, COUNT({c}) AS n, ROUND(AVG(({c} - m_{c}) / s_{c}), 9) + 0.0 AS mean, "
        f"{R6(f'STDDEV_POP(({c} - m_{c}) / s_{c})')} AS std FROM sp, fit GROUP BY split" for c in _E8_FEATS])
    fit = ", ".join(f"AVG({c}) AS m_{c}, CASE WHEN STDDEV_POP({c}) = 0 THEN 1 ELSE STDDEV_POP({c}) END AS s_{c}" for c in _E8_FEATS)
    return (f"WITH {SQL_LI_NULLS}, e8 AS (SELECT DISTINCT {kept} FROM (SELECT * FROM lin UNION ALL SELECT * FROM lin WHERE l_orderkey % 10 = 0)), "
            f"ed AS (SELECT *, {derived} FROM e8), "
            f"f AS ({CF._anova_sql('ed', _E8_FEATS, 'target')}), "
            "top AS (SELECT feature FROM f ORDER BY f_stat DESC NULLS LAST, position LIMIT 3), "
            f"{CF._split_sql('target').replace('lineitem', 'ed')}, fit AS (SELECT {fit} FROM sp WHERE split = 'train'), "
            f"sc AS ({scaled}) SELECT * FROM sc WHERE feature IN (SELECT feature FROM top)")


@query("e08_preprocess_flow", _e08_sql())
def e08(spark, sf):
    lin = li_with_nulls(spark, sf)
    lin = lin.unionByName(lin.where(F.col("l_orderkey") % 10 == 0))
    spec = FE.Derivation(groups={"rate_avg": ("mean", ["l_discount", "l_tax"]),
                                 "amount_max": ("max", ["l_quantity", "l_extendedprice"])},
                         ratios={"unit_price": ("l_extendedprice", "l_quantity")})
    prep = preprocess(lin, "l_linestatus", LI_KEY, spec, k_best=3, test_size=0.2, seed=42,
                      exclude=["l_shipdate"])
    parts = []
    for name, frame in (("train", prep.train), ("test", prep.test)):
        long = P.melt(frame, prep.features).groupBy("feature").agg(
            F.count("value").alias("n"), (F.round(F.avg("value"), 9) + F.lit(0.0)).alias("mean"), F.stddev_pop("value").alias("std"))
        parts.append(long.withColumn("split", F.lit(name)))
    return rounded(parts[0].unionByName(parts[1]))


# ---------------- W4 required columns ----------------
@query("w04_missing_required_columns",
       "SELECT 'missing_column' AS issue, c AS column_name, CAST(NULL AS DOUBLE) AS value FROM "
       "(VALUES ('target_missing_col'), ('score_col')) v(c) WHERE (SELECT COUNT(*) FROM lineitem) >= 0")
def w04(spark, sf):
    roles = Roles(numeric=("l_quantity", "l_tax"), target="target_missing_col", score="score_col")
    return Q.structure_validation(tbl(spark, sf, "lineitem"), roles).where(F.col("issue") == "missing_column")
