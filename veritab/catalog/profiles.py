"""Profiles, predicates, projections: A*, P*, W*, Q1-Q3, Q5-Q8."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritab.catalog.base import (LI_CATEGORICAL, LI_NUMERIC, LIN_COLS, LP_NUMERIC, SQL_LI_NULLS,
                                  SQL_LI_PRICED, SQL_LI_SIDES, li_priced, li_with_nulls,
                                  lineitem_sides, query, rounded, sql_melt, sql_quote, sql_round,
                                  sql_union, tbl)
from veritab.operators import profile as P
from veritab.operators import quality as Q
from veritab.operators import rules as R
from veritab.operators import shape as S
from veritab.roles import Roles

R6 = sql_round


def _describe_sql(src: str, cols, keep=()):
    k = "".join(f"{c}, " for c in keep)
    g = "".join(f"{c}, " for c in keep)
    return (f"SELECT {k}feature, COUNT(value) AS count, {R6('AVG(value)')} AS mean, "
            f"{R6('STDDEV_SAMP(value)')} AS std, {R6('MIN(value)')} AS min, "
            f"{R6('QUANTILE_CONT(value, 0.25)')} AS q25, {R6('QUANTILE_CONT(value, 0.5)')} AS q50, "
            f"{R6('QUANTILE_CONT(value, 0.75)')} AS q75, {R6('MAX(value)')} AS max "
            f"FROM ({sql_melt(src, cols, list(keep))}) m GROUP BY {g}feature")


def _listing_sql(src: str, cols):
    return sql_union([f"SELECT {i} AS position, '{c}' AS column_name, COUNT({sql_quote(c)}) AS non_null FROM {src}"
                      for i, c in enumerate(cols)])


# ---------------- A: aggregations ----------------
@query("a01_shape", "SELECT COUNT(*) AS n_rows, 11 AS n_columns FROM lineitem")
def a01(spark, sf):
    return P.shape(tbl(spark, sf, "lineitem"))


@query("a02_class_counts", "SELECT l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY l_returnflag")
def a02(spark, sf):
    return P.class_counts(tbl(spark, sf, "lineitem"), "l_returnflag")


@query("a03_class_shares",
       f"SELECT l_returnflag, COUNT(*) AS n, {R6('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()')} AS percent "
       "FROM lineitem GROUP BY l_returnflag")
def a03(spark, sf):
    return rounded(P.class_shares(tbl(spark, sf, "lineitem"), "l_returnflag"))


_A4_PARTS = [f"SELECT '{c}' AS column_name, CAST(COUNT(*) - COUNT({sql_quote(c)}) AS BIGINT) AS missing, "
             f"{R6(f'(COUNT(*) - COUNT({sql_quote(c)})) * 100.0 / COUNT(*)')} AS percent FROM lin"
             for c in LIN_COLS]
_A4_TOTAL = " + ".join(f"(COUNT(*) - COUNT({sql_quote(c)}))" for c in LIN_COLS)
_A4_PARTS.append(f"SELECT '__total__', CAST({_A4_TOTAL} AS BIGINT), {R6(f'({_A4_TOTAL}) * 100.0 / (COUNT(*) * {len(LIN_COLS)})')} FROM lin")


@query("a04_missing_values", f"WITH {SQL_LI_NULLS}\n{sql_union(_A4_PARTS)}")
def a04(spark, sf):
    return rounded(P.missing_values(li_with_nulls(spark, sf)))


@query("a05_describe", _describe_sql("lineitem", LI_NUMERIC))
def a05(spark, sf):
    return rounded(P.describe(tbl(spark, sf, "lineitem"), LI_NUMERIC))


@query("a06_describe_by_class", _describe_sql("lineitem", LI_NUMERIC, ["l_returnflag"]))
def a06(spark, sf):
    return rounded(P.describe(tbl(spark, sf, "lineitem"), LI_NUMERIC, by=["l_returnflag"]))


_EV_NUM = ["value", "user_id"]
_A7_SQL = (f"SELECT feature, {R6('q1')} AS q1, {R6('q3')} AS q3, {R6('q3 - q1')} AS iqr, "
           f"{R6('q1 - 1.5 * (q3 - q1)')} AS lower, {R6('q3 + 1.5 * (q3 - q1)')} AS upper FROM "
           f"(SELECT feature, QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.75) AS q3 "
           f"FROM ({sql_melt('events', _EV_NUM)}) m GROUP BY feature)")


@query("a07_iqr_fences", _A7_SQL)
def a07(spark, sf):
    return rounded(P.iqr_fences(tbl(spark, sf, "events"), _EV_NUM))


_OUT_CTE = (f"m AS ({sql_melt('events', _EV_NUM)}), f AS (SELECT feature, QUANTILE_CONT(value, 0.25) AS q1, "
            "QUANTILE_CONT(value, 0.75) AS q3 FROM m GROUP BY feature), "
            "o AS (SELECT m.feature, (m.value < q1 - 1.5 * (q3 - q1) OR m.value > q3 + 1.5 * (q3 - q1)) AS is_out "
            "FROM m JOIN f ON m.feature = f.feature)")


@query("a08_outlier_counts",
       f"WITH {_OUT_CTE} SELECT feature, COUNT(*) AS n, COUNT(*) FILTER (WHERE is_out) AS outliers, "
       f"{R6('COUNT(*) FILTER (WHERE is_out) * 100.0 / COUNT(*)')} AS percent FROM o GROUP BY feature")
def a08(spark, sf):
    return rounded(P.outlier_counts(tbl(spark, sf, "events"), _EV_NUM))


@query("a09_outlier_cells",
       f"WITH {_OUT_CTE} SELECT COUNT(*) FILTER (WHERE is_out) AS outlier_cells, "
       f"CAST(COUNT(*) / {len(_EV_NUM)} AS BIGINT) AS n_rows, {len(_EV_NUM)} AS n_columns, "
       f"{R6(f'COUNT(*) FILTER (WHERE is_out) * 100.0 / COUNT(*)')} AS percent FROM o")
def a09(spark, sf):
    return rounded(P.outlier_cells(tbl(spark, sf, "events"), _EV_NUM))


#: all columns; the rows of every 13th order occur twice, so that there are duplicates
_SQL_COPIED = "ld AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 13 = 0)"


def _copied(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return li.unionByName(li.where("l_orderkey % 13 = 0"))


@query("a10_duplicate_rows",
       f"WITH {_SQL_COPIED} SELECT CAST(SUM(c) AS BIGINT) AS n_rows, CAST(SUM(c - 1) AS BIGINT) AS duplicates, "
       f"{R6('SUM(c - 1) * 100.0 / SUM(c)')} AS percent FROM "
       "(SELECT COUNT(*) AS c FROM ld GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
       "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)")
def a10(spark, sf):
    return rounded(P.duplicate_rows(_copied(spark, sf)))


@query("a11_drop_duplicates",
       f"WITH {_SQL_COPIED} SELECT COUNT(*) AS n_rows, {R6('SUM(l_quantity)')} AS sum_quantity FROM (SELECT DISTINCT * FROM ld)")
def a11(spark, sf):
    d = P.drop_duplicates(_copied(spark, sf))
    return rounded(d.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_quantity")))


def _corr_sql():
    parts = []
    for i, a in enumerate(LP_NUMERIC):
        for j, b in enumerate(LP_NUMERIC):
            v = f"CASE WHEN STDDEV_POP({a}) > 0 THEN 1.0 END" if i == j else f"CORR({a}, {b})"
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {R6(v)} AS corr FROM lp")
    return f"WITH {SQL_LI_PRICED}\n{sql_union(parts)}"


@query("a12_correlation_matrix", _corr_sql())
def a12(spark, sf):
    return rounded(P.correlation_matrix(li_priced(spark, sf), LP_NUMERIC))


@query("a13_target_correlation",
       f"WITH {SQL_LI_PRICED}, t AS ("
       + sql_union([f"SELECT '{c}' AS feature, CORR({c}, CAST(target AS DOUBLE)) AS corr FROM lp" for c in LP_NUMERIC])
       + f") SELECT feature, {R6('corr')} AS corr FROM t ORDER BY corr DESC NULLS LAST, feature LIMIT 10")
def a13(spark, sf):
    return rounded(P.target_correlation(li_priced(spark, sf), LP_NUMERIC, F.col("target")))


@query("a14_strong_pairs",
       f"WITH {SQL_LI_PRICED}, c AS ("
       + sql_union([f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, CORR({a}, {b}) AS corr FROM lp"
                    for i, a in enumerate(LP_NUMERIC) for b in LP_NUMERIC[i + 1:]])
       + f") SELECT feature_a, feature_b, {R6('corr')} AS corr FROM c WHERE ABS(corr) > 0.7")
def a14(spark, sf):
    cm = P.correlation_matrix(li_priced(spark, sf), LP_NUMERIC)
    return rounded(P.strong_pairs(cm, LP_NUMERIC))


@query("a15_histogram",
       "WITH r AS (SELECT l_returnflag, MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem GROUP BY 1), "
       "g AS (SELECT l_returnflag, lo, hi, b AS bin FROM r, range(0, 20) t(b)), "
       "c AS (SELECT l.l_returnflag, CAST(CASE WHEN hi = lo THEN 0 ELSE LEAST(FLOOR((l_extendedprice - lo) / ((hi - lo) / 20)), 19) END AS INTEGER) AS bin, "
       "COUNT(*) AS n FROM lineitem l JOIN r ON l.l_returnflag = r.l_returnflag GROUP BY 1, 2) "
       f"SELECT g.l_returnflag, CAST(g.bin AS INTEGER) AS bin, {R6('lo + g.bin * ((hi - lo) / 20)')} AS bin_lo, "
       f"{R6('CASE WHEN g.bin = 19 THEN hi ELSE lo + (g.bin + 1) * ((hi - lo) / 20) END')} AS bin_hi, "
       "COALESCE(c.n, 0) AS n FROM g LEFT JOIN c ON g.l_returnflag = c.l_returnflag AND g.bin = c.bin")
def a15(spark, sf):
    return rounded(P.histogram(tbl(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"]))


@query("a16_box_stats",
       "WITH q AS (SELECT event_type, QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.5) AS med, "
       "QUANTILE_CONT(value, 0.75) AS q3 FROM events GROUP BY 1) "
       f"SELECT q.event_type, {R6('q1')} AS q1, {R6('med')} AS median, {R6('q3')} AS q3, "
       f"{R6('MIN(CASE WHEN NOT (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) THEN value END)')} AS whisker_low, "
       f"{R6('MAX(CASE WHEN NOT (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) THEN value END)')} AS whisker_high, "
       "COUNT(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS fliers "
       "FROM events e JOIN q ON e.event_type = q.event_type GROUP BY q.event_type, q1, med, q3")
def a16(spark, sf):
    return rounded(P.box_stats(tbl(spark, sf, "events"), "value", ["event_type"]))


@query("a18_argmax_row",
       "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def a18(spark, sf):
    return P.argmax_row(tbl(spark, sf, "orders"), "o_totalprice", ["o_orderkey"]) \
        .select("o_orderkey", "o_totalprice")


@query("a19_coefficient_of_variation",
       sql_union([f"SELECT '{c}' AS feature, {R6(f'AVG({c})')} AS mean, {R6(f'STDDEV_SAMP({c})')} AS std, "
                  f"{R6(f'STDDEV_SAMP({c}) / AVG({c})')} AS cv FROM lineitem" for c in LI_NUMERIC]))
def a19(spark, sf):
    return rounded(P.coefficient_of_variation(tbl(spark, sf, "lineitem"), LI_NUMERIC))


@query("a21_dataset_profile",
       "SELECT COUNT(*) AS n_rows, 11 AS n_columns, 8 AS n_numeric, 2 AS n_string FROM lineitem")
def a21(spark, sf):
    return P.dataset_profile(tbl(spark, sf, "lineitem"))


@query("a23_sample_counts",
       f"WITH {SQL_LI_PRICED} SELECT COUNT(*) FILTER (WHERE target = 0) AS negative, "
       "COUNT(*) FILTER (WHERE target = 1) AS positive, COUNT(*) AS total FROM lp")
def a23(spark, sf):
    return P.sample_counts(li_priced(spark, sf), "target")


# ---------------- P: projections and predicates ----------------
_AFTER_P1 = [c for c in LIN_COLS if c != "empty_col"]
_AFTER_P2 = [c for c in LIN_COLS if "Unnamed" not in c]


@query("p01_drop_null_columns", f"WITH {SQL_LI_NULLS}\n{_listing_sql('lin', _AFTER_P1)}")
def p01(spark, sf):
    return S.column_listing(S.drop_all_null_columns(li_with_nulls(spark, sf)))


@query("p02_drop_name_pattern", f"WITH {SQL_LI_NULLS}\n{_listing_sql('lin', _AFTER_P2)}")
def p02(spark, sf):
    return S.column_listing(S.drop_name_pattern(li_with_nulls(spark, sf), "Unnamed"))


_P3 = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("p03_numeric_columns", _listing_sql("lineitem", _P3))
def p03(spark, sf):
    return S.column_listing(S.numeric_columns(tbl(spark, sf, "lineitem"), exclude=["l_orderkey"]))


_P4 = ["l_extendedprice", "l_discount", "disc_price"]


@query("p04_columns_by_name", f"WITH {SQL_LI_PRICED}\n{_listing_sql('lp', _P4)}")
def p04(spark, sf):
    return S.column_listing(S.columns_containing(li_priced(spark, sf), ["price", "disc"]))


@query("p05_project_present", _listing_sql("lineitem", ["l_tax", "l_quantity"]))
def p05(spark, sf):
    return S.column_listing(S.project_present(tbl(spark, sf, "lineitem"),
                                              ["l_tax", "not_a_column", "l_quantity"]))


_P6 = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
       "l_discount", "l_tax"]


@query("p06_drop_columns", _listing_sql("lineitem", _P6))
def p06(spark, sf):
    return S.column_listing(S.drop_columns(tbl(spark, sf, "lineitem"),
                                           ["l_returnflag", "l_linestatus", "l_shipdate"]))


@query("p07_iqr_outlier_rows",
       "WITH f AS (SELECT QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.75) AS q3 FROM events) "
       f"SELECT COUNT(*) AS n, CAST(SUM(event_id) AS BIGINT) AS key_sum, {R6('SUM(value)')} AS value_sum "
       "FROM events, f WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)")
def p07(spark, sf):
    o = S.iqr_outlier_rows(tbl(spark, sf, "events"), "value")
    return rounded(o.agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("key_sum"),
                         F.sum("value").alias("value_sum")))


@query("p09_filter_by_class",
       f"SELECT COUNT(*) AS n, {R6('AVG(l_quantity)')} AS mean_quantity FROM lineitem WHERE l_returnflag = 'R'")
def p09(spark, sf):
    r = S.filter_class(tbl(spark, sf, "lineitem"), "l_returnflag", "R")
    return rounded(r.agg(F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("mean_quantity")))


@query("p10_metric_threshold_filter",
       f"WITH {SQL_LI_NULLS}, a AS (" + sql_union(
           [f"SELECT '{c}' AS column_name, CAST(COUNT(*) - COUNT({sql_quote(c)}) AS BIGINT) AS missing, "
            f"(COUNT(*) - COUNT({sql_quote(c)})) * 100.0 / COUNT(*) AS percent FROM lin" for c in LIN_COLS])
       + f") SELECT column_name, missing, {R6('percent')} AS percent FROM a WHERE percent > 10")
def p10(spark, sf):
    mv = P.missing_values(li_with_nulls(spark, sf)).where(F.col("column_name") != "__total__")
    return rounded(S.metric_rows_over(mv, "percent", 10.0))


@query("p11_membership_check",
       "SELECT COALESCE(BOOL_AND(l_returnflag IN ('A', 'N', 'R')), TRUE) AS passed FROM lineitem")
def p11(spark, sf):
    return S.all_in(tbl(spark, sf, "lineitem"), "l_returnflag", ["A", "N", "R"])


@query("p12_drop_nulls",
       f"WITH {SQL_LI_NULLS} SELECT COUNT(*) AS n, {R6('AVG(l_quantity)')} AS mean_quantity "
       "FROM lin WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL")
def p12(spark, sf):
    d = S.drop_nulls(li_with_nulls(spark, sf), ["l_quantity", "l_discount"])
    return rounded(d.agg(F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("mean_quantity")))


_P13_MISSING = " + ".join(f"(COUNT(*) - COUNT({c}))" for c in
                          ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                           "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                           "l_shipdate"])


@query("p13_verify_dataset",
       f"WITH a AS (SELECT COUNT(*) AS n, {_P13_MISSING} AS missing, "
       "COALESCE(BOOL_AND(l_returnflag IN ('A', 'N', 'R')), TRUE) AS valid FROM lineitem) "
       + sql_union(["SELECT 'rows' AS \"check\", n > 0 AS passed FROM a", "SELECT 'columns', TRUE FROM a",
                    "SELECT 'no_missing', missing = 0 FROM a", "SELECT 'target_present', TRUE FROM a",
                    "SELECT 'target_values', valid FROM a",
                    "SELECT 'all', n > 0 AND missing = 0 AND valid FROM a"]))
def p13(spark, sf):
    return S.verify_dataset(tbl(spark, sf, "lineitem"), "l_returnflag", ["A", "N", "R"])


@query("p14_head",
       "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem "
       "ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 5")
def p14(spark, sf):
    return S.head(tbl(spark, sf, "lineitem"), 5, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]) \
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


# ---------------- W: sort, top-k, normalise ----------------
_CORR_T = (f"t AS (" + sql_union([f"SELECT '{c}' AS feature, ABS(CORR({c}, CAST(target AS DOUBLE))) AS r FROM lp"
                                  for c in LP_NUMERIC]) + ")")


@query("w01_sort_desc",
       f"WITH {SQL_LI_PRICED}, {_CORR_T} SELECT feature, {R6('r')} AS r, "
       "CAST(ROW_NUMBER() OVER (ORDER BY r DESC NULLS LAST, feature) AS INTEGER) AS rank FROM t")
def w01(spark, sf):
    lp = li_priced(spark, sf)
    one = lp.agg(*[F.abs(F.corr(c, F.col("target").cast("double"))).alias(c) for c in LP_NUMERIC])
    long = one.unpivot([], LP_NUMERIC, "feature", "r")
    return rounded(P.sort_desc(long, "r", "feature"))


@query("w02_top_k",
       "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem "
       "ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 10")
def w02(spark, sf):
    return P.top_k(tbl(spark, sf, "lineitem"), "l_extendedprice", 10,
                   ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]) \
        .select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("w03_normalise_by_max",
       f"SELECT o_orderkey, {R6('o_totalprice / MAX(o_totalprice) OVER ()')} AS normalised FROM orders")
def w03(spark, sf):
    return rounded(P.normalise_by_max(tbl(spark, sf, "orders"), "o_totalprice").select("o_orderkey", "normalised"))


# ---------------- Q: quality ----------------
_Q1_ROLES = Roles(numeric=("l_quantity", "l_discount", "l_returnflag"), categorical=(),
                  target="target_missing_col")


@query("q01_structure_validation",
       f"WITH {SQL_LI_NULLS} SELECT 'missing_column' AS issue, 'target_missing_col' AS column_name, "
       "CAST(NULL AS DOUBLE) AS value UNION ALL SELECT 'non_numeric', 'l_returnflag', NULL UNION ALL "
       f"SELECT * FROM (" + sql_union([f"SELECT 'missing_share' AS issue, '{c}' AS column_name, {R6(f'(COUNT(*) - COUNT({c})) * 1.0 / COUNT(*)')} AS value FROM lin"
                                      for c in ["l_quantity", "l_discount", "l_returnflag"]])
       + ") WHERE value > 0.1")
def q01(spark, sf):
    return rounded(Q.structure_validation(li_with_nulls(spark, sf), _Q1_ROLES))


#: every column of the table; a null quantity in every 17th order, the rows of every 13th order twice
_Q2_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]
_Q2_LIST = ", ".join("CASE WHEN l_orderkey % 17 <> 0 THEN l_quantity END AS l_quantity" if c == "l_quantity" else c for c in _Q2_COLS)
_Q2_SQL_CTE = (f"s0 AS (SELECT side, {_Q2_LIST} FROM li), s AS (SELECT * FROM s0 UNION ALL SELECT * FROM s0 WHERE l_orderkey % 13 = 0), "
               f"g AS (SELECT side, COUNT(*) AS c, MAX({' + '.join(f'({c} IS NULL)::INT' for c in _Q2_COLS)}) AS nulls "
               f"FROM s GROUP BY side, {', '.join(_Q2_COLS)}), "
               "p AS (SELECT side, SUM(c) AS n_rows, SUM(c * nulls) AS missing_cells, SUM(c - 1) AS duplicates FROM g GROUP BY side)")


def _q2_frame(spark, sf):
    t = lineitem_sides(spark, sf).select("side", *_Q2_COLS)
    t = t.withColumn("l_quantity", F.when(F.col("l_orderkey") % 17 != 0, F.col("l_quantity")))
    return t.unionByName(t.where("l_orderkey % 13 = 0"))


@query("q02_dataset_summary",
       f"WITH {SQL_LI_SIDES}, {_Q2_SQL_CTE} SELECT side, CAST(n_rows AS BIGINT) AS n_rows, 11 AS n_columns, "
       f"CAST(missing_cells AS BIGINT) AS missing_cells, {R6('missing_cells / (n_rows * 11.0)')} AS missing_share, "
       f"CAST(duplicates AS BIGINT) AS duplicates, {R6('duplicates * 1.0 / n_rows')} AS duplicate_share FROM p")
def q02(spark, sf):
    return rounded(Q.dataset_summary(_q2_frame(spark, sf)))


@query("q03_quality_score",
       f"WITH {SQL_LI_SIDES}, {_Q2_SQL_CTE} SELECT side, {R6('missing_cells / (n_rows * 11.0)')} AS missing_share, "
       f"{R6('duplicates * 1.0 / n_rows')} AS duplicate_share, "
       f"{R6('((1 - missing_cells / (n_rows * 11.0)) + (1 - duplicates * 1.0 / n_rows)) / 2')} AS quality_score FROM p")
def q03(spark, sf):
    return rounded(Q.quality_score(_q2_frame(spark, sf)))


@query("q05_stability",
       "WITH g AS (SELECT COUNT(*) AS c, COUNT(DISTINCT l_returnflag) AS t FROM lineitem GROUP BY l_quantity, l_discount) "
       "SELECT CAST(SUM(c) AS BIGINT) AS n_rows, CAST(COALESCE(SUM(CASE WHEN t > 1 THEN c END), 0) AS BIGINT) AS unstable_rows, "
       f"{R6('COALESCE(SUM(CASE WHEN t > 1 THEN c END), 0) * 1.0 / SUM(c)')} AS share FROM g")
def q05(spark, sf):
    return rounded(Q.stability(tbl(spark, sf, "lineitem"), ["l_quantity", "l_discount"], "l_returnflag"))


def _q06_sql():
    num = []
    for c in LI_NUMERIC:
        num.append(f"SELECT side, '{c}' AS feature, COUNT({c}) AS count, COUNT(*) - COUNT({c}) AS missing, "
                   f"COUNT(DISTINCT {c}) AS distinct, CAST(NULL AS VARCHAR) AS mode_text, "
                   f"{R6(f'ARG_MIN({c}, [-(COUNT(*) OVER (PARTITION BY side, {c})), {c}])')} AS mode_num_dummy, "
                   f"{R6(f'AVG({c})')} AS mean, {R6(f'STDDEV_SAMP({c})')} AS std, {R6(f'MIN({c})')} AS min, "
                   f"{R6(f'QUANTILE_CONT({c}, 0.25)')} AS q25, {R6(f'QUANTILE_CONT({c}, 0.5)')} AS q50, "
                   f"{R6(f'QUANTILE_CONT({c}, 0.75)')} AS q75, {R6(f'MAX({c})')} AS max FROM li GROUP BY side")
    return num


def _mode_sql(col: str, text: bool):
    v = col
    return (f"(SELECT side, {v} AS v, COUNT(*) AS n FROM li WHERE {v} IS NOT NULL GROUP BY side, {v})")


def _q06_full_sql():
    parts = []
    for c in LI_NUMERIC:
        parts.append(
            f"SELECT a.side, '{c}' AS feature, a.count, a.missing, a.distinct, CAST(NULL AS VARCHAR) AS mode_text, "
            f"{R6('m.mode_num')} AS mode_num, a.mean, a.std, a.min, a.q25, a.q50, a.q75, a.max FROM "
            f"(SELECT side, COUNT({c}) AS count, COUNT(*) - COUNT({c}) AS missing, COUNT(DISTINCT {c}) AS distinct, "
            f"{R6(f'AVG({c})')} AS mean, {R6(f'STDDEV_SAMP({c})')} AS std, {R6(f'MIN({c})')} AS min, "
            f"{R6(f'QUANTILE_CONT({c}, 0.25)')} AS q25, {R6(f'QUANTILE_CONT({c}, 0.5)')} AS q50, "
            f"{R6(f'QUANTILE_CONT({c}, 0.75)')} AS q75, {R6(f'MAX({c})')} AS max FROM li GROUP BY side) a JOIN "
            f"(SELECT side, ARG_MIN(v, (-n, v)) AS mode_num FROM {_mode_sql(c, False)} GROUP BY side) m ON a.side = m.side")
    for c in LI_CATEGORICAL:
        parts.append(
            f"SELECT a.side, '{c}' AS feature, a.count, a.missing, a.distinct, m.mode_text, "
            "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
            "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM "
            f"(SELECT side, COUNT({c}) AS count, COUNT(*) - COUNT({c}) AS missing, COUNT(DISTINCT {c}) AS distinct "
            f"FROM li GROUP BY side) a JOIN "
            f"(SELECT side, ARG_MIN(v, (-n, v)) AS mode_text FROM {_mode_sql(c, True)} GROUP BY side) m ON a.side = m.side")
    return f"WITH {SQL_LI_SIDES}\n{sql_union(parts)}"


@query("q06_column_profile", _q06_full_sql())
def q06(spark, sf):
    return rounded(P.column_profile(lineitem_sides(spark, sf), LI_NUMERIC, LI_CATEGORICAL, by=["side"]))


@query("q07_quality_alerts",
       f"WITH {SQL_LI_SIDES}, {_Q2_SQL_CTE}, m AS ("
       "SELECT side AS scope, 'missing_share' AS metric, missing_cells / (n_rows * 11.0) AS value FROM p UNION ALL "
       "SELECT side, 'duplicate_share', duplicates * 1.0 / n_rows FROM p UNION ALL "
       "SELECT side, 'quality_score', ((1 - missing_cells / (n_rows * 11.0)) + (1 - duplicates * 1.0 / n_rows)) / 2 FROM p), "
       "r AS (SELECT * FROM (VALUES ('low_quality_score', 'quality_score', 0.8, 'Low data quality score: '), "
       "('too_many_missing', 'missing_share', 0.1, 'Too many missing values: '), "
       "('too_many_duplicates', 'duplicate_share', 0.05, 'Too many duplicate rows: ')) r(rule, metric, lim, msg)) "
       f"SELECT rule, scope, m.metric, {R6('value')} AS value, {R6('lim')} AS \"limit\", "
       "msg || scope || ' ' || printf('%.2f', value) AS message FROM m JOIN r ON m.metric = r.metric "
       "WHERE (r.rule = 'low_quality_score' AND value < lim) OR (r.rule <> 'low_quality_score' AND value > lim)")
def q07(spark, sf):
    s = Q.quality_score(_q2_frame(spark, sf))
    d = Q.dataset_summary(_q2_frame(spark, sf))
    metrics = (d.select(F.col("side").alias("scope"), F.lit("missing_share").alias("metric"),
                        F.col("missing_share").alias("value"))
               .unionByName(d.select(F.col("side").alias("scope"), F.lit("duplicate_share").alias("metric"),
                                     F.col("duplicate_share").alias("value")))
               .unionByName(s.select(F.col("side").alias("scope"), F.lit("quality_score").alias("metric"),
                                     F.col("quality_score").alias("value"))))
    return rounded(R.apply_rules(metrics, R.rule_table(spark, R.QUALITY_RULES)))


@query("q08_outlier_rule",
       f"WITH {_OUT_CTE} SELECT {R6('COUNT(*) FILTER (WHERE is_out) * 1.0 / COUNT(*)')} AS outlier_share, "
       "COUNT(*) FILTER (WHERE is_out) * 1.0 / COUNT(*) > 0.05 AS flagged FROM o")
def q08(spark, sf):
    c = P.outlier_cells(tbl(spark, sf, "events"), _EV_NUM)
    share = F.col("outlier_cells") / (F.col("n_rows") * F.col("n_columns"))
    return rounded(c.select(share.alias("outlier_share"), (share > 0.05).alias("flagged")))
