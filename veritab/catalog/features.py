"""Feature pipeline queries: E1-E7, M5, M6."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritab.catalog.base import (LI_KEY, LI_NUMERIC, LIN_COLS, SQL_LI_NULLS, li_with_nulls, query,
                                  rounded, sql_round, sql_union, tbl)
from veritab.operators import features as FE
from veritab.operators.profile import melt
from veritab.operators.shape import column_listing

R6 = sql_round
_MD5 = "md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, '42'))"


def _li_dups(spark, sf):
    lin = li_with_nulls(spark, sf)
    return lin.unionByName(lin.where(F.col("l_orderkey") % 10 == 0))


_KEEP = [c for c in LIN_COLS if c not in ("empty_col", "Unnamed: 32")]


@query("e01_clean",
       f"WITH {SQL_LI_NULLS}, d AS (SELECT * FROM lin UNION ALL SELECT * FROM lin WHERE l_orderkey % 10 = 0), "
       f"a AS (SELECT COUNT(*) AS rows_after FROM (SELECT DISTINCT {', '.join(_KEEP)} FROM d)) "
       "SELECT (SELECT COUNT(*) FROM d) AS rows_before, rows_after, (SELECT COUNT(*) FROM d) - rows_after AS rows_removed, "
       "13 AS columns_before, 11 AS columns_after, 2 AS columns_removed FROM a")
def e01(spark, sf):
    _, counts = FE.clean(_li_dups(spark, sf))
    return counts


_DERIVE = FE.Derivation(
    groups={"rate_avg": ("mean", ["l_discount", "l_tax"]), "rate_std": ("std", ["l_discount", "l_tax"]),
            "amount_avg": ("mean", ["l_quantity", "l_extendedprice"]),
            "amount_max": ("max", ["l_quantity", "l_extendedprice"])},
    ratios={"unit_price": ("l_extendedprice", "l_quantity"), "tax_per_discount": ("l_tax", "l_discount"),
            "absent_ratio": ("no_such_column", "l_tax")})
_DERIVED = ["rate_avg", "rate_std", "amount_avg", "amount_max", "unit_price", "tax_per_discount"]


def _sql_mean(cols):
    s = " + ".join(f"COALESCE({c}, 0)" for c in cols)
    n = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols)
    return f"(CASE WHEN ({n}) > 0 THEN ({s}) / ({n}) END)"


def _sql_std(cols):
    m = _sql_mean(cols)
    n = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols)
    ss = " + ".join(f"COALESCE(({c} - {m}) * ({c} - {m}), 0)" for c in cols)
    return f"(CASE WHEN ({n}) > 1 THEN SQRT(({ss}) / (({n}) - 1)) END)"


_E2_SQL = (f"WITH {SQL_LI_NULLS}, dv AS (SELECT {_sql_mean(['l_discount', 'l_tax'])} AS rate_avg, "
           f"{_sql_std(['l_discount', 'l_tax'])} AS rate_std, {_sql_mean(['l_quantity', 'l_extendedprice'])} AS amount_avg, "
           "GREATEST(l_quantity, l_extendedprice) AS amount_max, "
           "CASE WHEN l_quantity <> 0 THEN l_extendedprice / l_quantity END AS unit_price, "
           "CASE WHEN l_discount <> 0 THEN l_tax / l_discount END AS tax_per_discount FROM lin) "
           + sql_union([f"SELECT '{c}' AS feature, COUNT({c}) AS non_null, {R6(f'SUM({c})', 4)} AS total, "
                        f"{R6(f'MIN({c})')} AS min, {R6(f'MAX({c})')} AS max FROM dv" for c in _DERIVED]))


@query("e02_derive_features", _E2_SQL)
def e02(spark, sf):
    d = FE.derive(li_with_nulls(spark, sf), _DERIVE)
    long = melt(d, _DERIVED)
    g = long.groupBy("feature").agg(F.count("value").alias("non_null"), F.round(F.sum("value"), 4).alias("total"),
                                    F.min("value").alias("min"), F.max("value").alias("max"))
    return rounded(g)


@query("e03_encode_target",
       "SELECT l_returnflag AS value, CAST(DENSE_RANK() OVER (ORDER BY l_returnflag) - 1 AS INTEGER) AS index, "
       "COUNT(*) AS n FROM lineitem GROUP BY l_returnflag")
def e03(spark, sf):
    enc, _ = FE.encode_target(tbl(spark, sf, "lineitem"), "l_returnflag", "index")
    return enc.groupBy(F.col("l_returnflag").alias("value"), "index").agg(F.count(F.lit(1)).alias("n"))


_E4_FEATS = [*LI_NUMERIC, "l_partkey"]


def _anova_sql(src, feats, label):
    parts = []
    for i, f in enumerate(feats):
        parts.append(
            f"SELECT {i} AS position, '{f}' AS feature, {R6('(b / (k - 1)) / (w / (n - k))')} AS f_stat FROM ("
            f"SELECT SUM(nk) AS n, COUNT(*) FILTER (WHERE nk > 0) AS k, SUM(nk * (mk - g) * (mk - g)) AS b, "
            f"SUM(COALESCE((nk - 1) * vk, 0)) AS w FROM (SELECT nk, mk, vk, SUM(nk * mk) OVER () / SUM(nk) OVER () AS g FROM "
            f"(SELECT COUNT({f}) AS nk, AVG({f}) AS mk, VAR_SAMP({f}) AS vk FROM {src} GROUP BY {label})))")
    return sql_union(parts)


@query("e04_anova_f", _anova_sql("lineitem", _E4_FEATS, "l_returnflag"))
def e04(spark, sf):
    return rounded(FE.anova_f(tbl(spark, sf, "lineitem"), _E4_FEATS, "l_returnflag"))


@query("e05_select_k_best",
       f"WITH s AS ({_anova_sql('lineitem', _E4_FEATS, 'l_returnflag')}), "
       "top AS (SELECT position, feature FROM s ORDER BY f_stat DESC NULLS LAST, position LIMIT 3) "
       "SELECT CAST(ROW_NUMBER() OVER (ORDER BY position) - 1 AS INTEGER) AS position, feature AS column_name, "
       "(SELECT COUNT(*) FROM lineitem) AS non_null FROM top")
def e05(spark, sf):
    sel, _ = FE.select_k_best(tbl(spark, sf, "lineitem"), _E4_FEATS, "l_returnflag", 3)
    return column_listing(sel)


def _split_sql(label: str, test_size: float = 0.2) -> str:
    return (f"c AS (SELECT {label} AS lbl, COUNT(*) AS n_k FROM lineitem GROUP BY 1), "
            f"tt AS (SELECT CEIL(SUM(n_k) * CAST({test_size} AS DOUBLE)) AS t, SUM(n_k) AS n FROM c), "
            "q1 AS (SELECT lbl, n_k, t * n_k / CAST(n AS DOUBLE) AS ex, FLOOR(t * n_k / CAST(n AS DOUBLE)) AS base, t FROM c, tt), "
            "q2 AS (SELECT *, t - SUM(base) OVER () AS lft, ROW_NUMBER() OVER (ORDER BY ex - base DESC, lbl) AS o FROM q1), "
            "q AS (SELECT lbl, base + CASE WHEN o <= lft THEN 1 ELSE 0 END AS quota FROM q2), "
            f"r AS (SELECT l.*, ROW_NUMBER() OVER (PARTITION BY {label} ORDER BY {_MD5}) AS rk FROM lineitem l), "
            f"sp AS (SELECT r.*, CASE WHEN rk <= quota THEN 'test' ELSE 'train' END AS split FROM r JOIN q ON r.{label} = q.lbl)")


@query("e06_stratified_split",
       f"WITH {_split_sql('l_returnflag')} SELECT split, l_returnflag, COUNT(*) AS n, "
       "CAST(SUM(l_orderkey) AS BIGINT) AS orderkey_sum, CAST(SUM(l_partkey) AS BIGINT) AS partkey_sum "
       "FROM sp GROUP BY split, l_returnflag")
def e06(spark, sf):
    s = FE.stratified_split(tbl(spark, sf, "lineitem"), "l_returnflag", LI_KEY, 0.2, 42)
    return s.groupBy("split", "l_returnflag").agg(F.count(F.lit(1)).alias("n"),
                                                  F.sum("l_orderkey").alias("orderkey_sum"),
                                                  F.sum("l_partkey").alias("partkey_sum"))


_E7_FEATS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("e07_standard_scale",
       f"WITH {_split_sql('l_returnflag')}, fit AS (SELECT "
       + ", ".join(f"AVG({c}) AS m_{c}, CASE WHEN STDDEV_POP({c}) = 0 THEN 1 ELSE STDDEV_POP({c}) END AS s_{c}" for c in _E7_FEATS)
       + " FROM sp WHERE split = 'train'), sc AS (SELECT split, "
       + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in _E7_FEATS) + " FROM sp, fit) "
       + sql_union([f"SELECT split, '{c}' AS feature, ROUND(AVG({c}), 9) + 0.0 AS mean, {R6(f'STDDEV_POP({c})')} AS std "
                    f"FROM sc GROUP BY split" for c in _E7_FEATS]))
def e07(spark, sf):
    s = FE.stratified_split(tbl(spark, sf, "lineitem"), "l_returnflag", LI_KEY, 0.2, 42)
    train, test, _ = FE.standard_scale(s.where("split = 'train'"), s.where("split = 'test'"), _E7_FEATS)
    long = melt(train.unionByName(test), _E7_FEATS, by=["split"])
    # a scaled mean is 0 but for the order of additions: rounded, and never -0
    return rounded(long.groupBy("split", "feature").agg((F.round(F.avg("value"), 9) + F.lit(0.0)).alias("mean"),
                                                         F.stddev_pop("value").alias("std")))


@query("m05_class_weights",
       f"SELECT l_returnflag, COUNT(*) AS n, {R6('SUM(COUNT(*)) OVER () / (COUNT(*) OVER () * COUNT(*))')} AS weight "
       "FROM lineitem GROUP BY l_returnflag")
def m05(spark, sf):
    w = FE.balanced_weights(tbl(spark, sf, "lineitem"), "l_returnflag")
    return rounded(w.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.first("weight").alias("weight")))


@query("m06_stratified_folds",
       f"WITH r AS (SELECT l.*, ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY {_MD5}) AS rk FROM lineitem l) "
       "SELECT CAST((rk - 1) % 5 AS INTEGER) AS fold, l_returnflag, COUNT(*) AS n, "
       "CAST(SUM(l_orderkey) AS BIGINT) AS orderkey_sum FROM r GROUP BY 1, 2")
def m06(spark, sf):
    f = FE.stratified_folds(tbl(spark, sf, "lineitem"), "l_returnflag", LI_KEY, 5, 42)
    return f.groupBy("fold", "l_returnflag").agg(F.count(F.lit(1)).alias("n"),
                                                 F.sum("l_orderkey").alias("orderkey_sum"))
