"""Scalar function queries F1-F15: each function applied over a whole table, summarised."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritab.catalog.base import (LI_NUMERIC, SQL_LI_NULLS, SQL_LI_SCORED, SQL_LI_SIDES, li_scored,
                                  li_with_nulls, lineitem_sides, query, rounded, sql_round, tbl)
from veritab.functions import scalar as S

R6 = sql_round


def _summary(df, col):
    return rounded(df.agg(F.count(col).alias("non_null"), F.round(F.sum(col), 4).alias("total"),
                          F.min(col).alias("min"), F.max(col).alias("max")))


def _summary_sql(expr, src="lin", cte=SQL_LI_NULLS):
    return (f"WITH {cte}, v AS (SELECT {expr} AS x FROM {src}) SELECT COUNT(x) AS non_null, "
            f"{R6('SUM(x)', 4)} AS total, {R6('MIN(x)')} AS min, {R6('MAX(x)')} AS max FROM v")


def _mean_sql(cols):
    s = " + ".join(f"COALESCE({c}, 0)" for c in cols)
    n = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols)
    return f"(CASE WHEN ({n}) > 0 THEN ({s}) / ({n}) END)"


_F1 = ["l_quantity", "l_discount", "l_tax"]


@query("f01_row_mean", _summary_sql(_mean_sql(_F1)))
def f01(spark, sf):
    return _summary(li_with_nulls(spark, sf).select(S.row_mean(_F1).alias("x")), "x")


def _std_sql(cols):
    m = _mean_sql(cols)
    n = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols)
    ss = " + ".join(f"COALESCE(({c} - {m}) * ({c} - {m}), 0)" for c in cols)
    return f"(CASE WHEN ({n}) > 1 THEN SQRT(({ss}) / (({n}) - 1)) END)"


@query("f02_row_std", _summary_sql(_std_sql(_F1)))
def f02(spark, sf):
    return _summary(li_with_nulls(spark, sf).select(S.row_std(_F1).alias("x")), "x")


@query("f03_row_max", _summary_sql("GREATEST(l_quantity, l_discount, l_tax)"))
def f03(spark, sf):
    return _summary(li_with_nulls(spark, sf).select(S.row_max(_F1).alias("x")), "x")


@query("f04_safe_ratio", _summary_sql("CASE WHEN l_discount <> 0 THEN l_tax / l_discount END"))
def f04(spark, sf):
    return _summary(li_with_nulls(spark, sf).select(S.safe_ratio("l_tax", "l_discount").alias("x")), "x")


@query("f05_clamp_floor",
       "SELECT " + f"{R6('SUM(LEAST(1.0, l_discount * 20))', 4)} AS capped_sum, "
       f"{R6('SUM(GREATEST(0.001, l_tax - 0.04))', 4)} AS floored_sum, "
       f"{R6('SUM(GREATEST(0.0, 100.0 - l_quantity * 3))', 4)} AS score_sum, "
       f"{R6('SUM(ABS(l_tax - l_discount))', 4)} AS abs_sum FROM lineitem")
def f05(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return rounded(li.agg(F.round(F.sum(S.clamp01(F.col("l_discount") * 20)), 4).alias("capped_sum"),
                          F.round(F.sum(S.floor_at(F.col("l_tax") - 0.04, 0.001)), 4).alias("floored_sum"),
                          F.round(F.sum(S.floor_at(F.lit(100.0) - F.col("l_quantity") * 3, 0.0)), 4).alias("score_sum"),
                          F.round(F.sum(F.abs(F.col("l_tax") - F.col("l_discount"))), 4).alias("abs_sum")))


@query("f06_status_bands",
       "SELECT 'quality' AS kind, CASE WHEN l_quantity * 2 >= 90 THEN 'good' WHEN l_quantity * 2 >= 70 THEN 'warning' "
       "ELSE 'critical' END AS status, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 UNION ALL "
       "SELECT 'drift', CASE WHEN l_discount * 4 < 0.1 THEN 'stable' WHEN l_discount * 4 < 0.3 THEN 'minor' ELSE 'high' END, "
       "COUNT(*) FROM lineitem GROUP BY 1, 2")
def f06(spark, sf):
    li = tbl(spark, sf, "lineitem")
    q = li.groupBy(F.lit("quality").alias("kind"), S.quality_band(F.col("l_quantity") * 2).alias("status")).count()
    d = li.groupBy(F.lit("drift").alias("kind"), S.drift_band(F.col("l_discount") * 4).alias("status")).count()
    return q.unionByName(d).withColumnRenamed("count", "n")


def _conf_sql(p):
    return (f"CASE WHEN {p} >= 0.9 THEN 'Molto Alta' WHEN {p} >= 0.8 THEN 'Alta' WHEN {p} >= 0.7 THEN 'Media' "
            f"WHEN {p} >= 0.6 THEN 'Bassa' ELSE 'Molto Bassa' END")


@query("f07_confidence_band",
       f"WITH {SQL_LI_SCORED} SELECT {_conf_sql('score')} AS confidence, COUNT(*) AS n FROM ls GROUP BY 1")
def f07(spark, sf):
    return li_scored(spark, sf).groupBy(S.confidence_band("score").alias("confidence")).agg(F.count(F.lit(1)).alias("n"))


@query("f08_label_text",
       f"WITH {SQL_LI_SCORED} SELECT CASE WHEN prediction = 1 THEN 'Maligno' ELSE 'Benigno' END AS prediction_label, "
       "COUNT(*) AS n FROM ls GROUP BY 1")
def f08(spark, sf):
    return li_scored(spark, sf).groupBy(S.label_text("prediction").alias("prediction_label")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("f09_binary_target",
       "SELECT CAST(SUM(CAST(l_returnflag = 'A' AS INTEGER)) AS BIGINT) AS positives, COUNT(*) AS n FROM lineitem")
def f09(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return li.agg(F.sum(S.binary_target("l_returnflag", "A")).cast("long").alias("positives"),
                  F.count(F.lit(1)).alias("n"))


@query("f10_timestamp_text",
       "SELECT COUNT(DISTINCT strftime(o_orderdate, '%Y%m%d_%H%M%S')) AS distinct_stamps, "
       "MIN(strftime(o_orderdate, '%Y%m%d_%H%M%S')) AS first_stamp, MAX(strftime(o_orderdate, '%Y%m%d_%H%M%S')) AS last_stamp FROM orders")
def f10(spark, sf):
    o = tbl(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyyMMdd_HHmmss").alias("s"))
    return o.agg(F.count_distinct("s").alias("distinct_stamps"), F.min("s").alias("first_stamp"),
                 F.max("s").alias("last_stamp"))


@query("f11_number_text",
       "SELECT printf('%.2f', o_totalprice / 1000) AS fixed_text, printf('%.1f', o_totalprice / 5000) || '%' AS percent_text, "
       "o_orderkey FROM orders")
def f11(spark, sf):
    return tbl(spark, sf, "orders").select(S.fmt_fixed(F.col("o_totalprice") / 1000, 2).alias("fixed_text"),
                      S.fmt_percent(F.col("o_totalprice") / 500000, 1).alias("percent_text"), "o_orderkey")


@query("f12_map_keys",
       "SELECT CASE WHEN l_orderkey % 13 = 0 THEN 'l_discount,l_quantity' ELSE 'l_discount,l_quantity,l_tax' END AS keys, "
       "COUNT(*) AS n FROM lineitem GROUP BY 1")
def f12(spark, sf):
    li = tbl(spark, sf, "lineitem")
    full = F.create_map(F.lit("l_quantity"), F.col("l_quantity"), F.lit("l_discount"), F.col("l_discount"),
                        F.lit("l_tax"), F.col("l_tax"))
    part = F.create_map(F.lit("l_quantity"), F.col("l_quantity"), F.lit("l_discount"), F.col("l_discount"))
    rec = li.select(F.when(F.col("l_orderkey") % 13 == 0, part).otherwise(full).alias("record"))
    return rec.groupBy(F.array_join(F.array_sort(S.map_keys_of("record")), ",").alias("keys")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("f13_json_parse",
       "SELECT event_type, CAST(SUM(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS k_sum, COUNT(*) AS n "
       "FROM events GROUP BY event_type")
def f13(spark, sf):
    e = tbl(spark, sf, "events").withColumn("p", F.from_json("props", "k int"))
    # round trip: serialise the parsed struct and parse it again
    e = e.withColumn("p", F.from_json(F.to_json("p"), "k int"))
    return e.groupBy("event_type").agg(F.sum("p.k").cast("long").alias("k_sum"), F.count(F.lit(1)).alias("n"))


@query("f14_capitalize",
       "SELECT upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) AS title, upper(event_type) AS upper_name, "
       "COUNT(*) AS n FROM events GROUP BY 1, 2")
def f14(spark, sf):
    e = tbl(spark, sf, "events")
    return e.groupBy(F.initcap("event_type").alias("title"), F.upper("event_type").alias("upper_name")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("f15_relative_change",
       f"WITH {SQL_LI_SIDES}, a AS (SELECT " + ", ".join(
           f"AVG(CASE WHEN side = 'reference' THEN {c} END) AS r_{c}, AVG(CASE WHEN side = 'current' THEN {c} END) AS c_{c}"
           for c in LI_NUMERIC) + " FROM li) " + " UNION ALL ".join(
           f"SELECT '{c}' AS feature, {R6(f'CASE WHEN r_{c} > 0 THEN (c_{c} - r_{c}) / r_{c} END')} AS relative_change, "
           f"CASE WHEN c_{c} - r_{c} > 0 THEN 'increase' WHEN c_{c} - r_{c} < 0 THEN 'decrease' ELSE 'unchanged' END AS direction FROM a"
           for c in LI_NUMERIC))
def f15(spark, sf):
    t = lineitem_sides(spark, sf)
    one = t.agg(*[e for c in LI_NUMERIC for e in (
        F.avg(F.when(F.col("side") == "reference", F.col(c))).alias(f"r_{c}"),
        F.avg(F.when(F.col("side") == "current", F.col(c))).alias(f"c_{c}"))])
    return rounded(one.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("feature"), S.relative_change(f"c_{c}", f"r_{c}").alias("relative_change"),
        S.direction_word(F.col(f"c_{c}") - F.col(f"r_{c}")).alias("direction")) for c in LI_NUMERIC]))))
