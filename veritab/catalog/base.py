"""Query registry and shared fixtures of the checked queries (FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from veritab.sources.io import load_table


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


SIG_DIGITS = 10


def sig_round(c, digits: int = SIG_DIGITS):
    """Round to ``digits`` significant digits. The value is scaled into [1, 10) by an exact
    power of ten (multiplying or dividing by 10^k, k <= 22, is exact-rounded in both
    engines), rounded, and scaled back, so Spark and DuckDB give the same double even when
    their float sums differ in the last bits."""
    a = F.abs(c)
    e = F.floor(F.log10(a)).cast("int")
    up = F.pow(F.lit(10.0), e.cast("double"))
    down = F.pow(F.lit(10.0), (-e).cast("double"))
    r = F.when(e >= 0, F.round(c / up, digits - 1) * up).otherwise(F.round(c * down, digits - 1) / down)
    return F.when(c.isNull() | (c == 0) | F.isnan(c) | (a == float("inf")), c).otherwise(r)


def rounded(df: DataFrame, digits: int = SIG_DIGITS) -> DataFrame:
    """Normalise floating columns (significant-digit rounding) so float-sum order cannot
    change the value hash."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = sig_round(c.cast("double"), digits).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def tbl(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return load_table(spark, sf, name)


# ---- lineitem monitoring fixture: reference = shipped before 1998 ----
REF_CUTOFF = "1998-01-01"
LI_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_CATEGORICAL = ["l_returnflag", "l_linestatus"]
LI_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def li_is_reference():
    return F.col("l_shipdate") < F.lit(REF_CUTOFF).cast("timestamp")


def lineitem_sides(spark: SparkSession, sf: str) -> DataFrame:
    li = tbl(spark, sf, "lineitem")
    return li.withColumn("side", F.when(li_is_reference(), "reference").otherwise("current"))


SQL_LI_SIDES = (f"li AS (SELECT *, CASE WHEN l_shipdate < TIMESTAMP '{REF_CUTOFF}' "
                "THEN 'reference' ELSE 'current' END AS side FROM lineitem)")


def sql_union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def sql_round(expr: str, digits: int | None = None) -> str:
    """SQL twin of ``rounded``: optional fixed-decimal rounding first (when the Spark side
    rounds explicitly too), then significant-digit rounding; "+ 0.0" turns -0.0 into 0.0."""
    x = f"CAST({expr} AS DOUBLE)" if digits is None else f"ROUND(CAST({expr} AS DOUBLE), {digits})"
    e = f"FLOOR(LOG10(ABS({x})))"
    d = SIG_DIGITS - 1
    sig = (f"CASE WHEN {x} IS NULL OR {x} = 0 OR isnan({x}) OR isinf({x}) THEN {x} "
           f"WHEN {e} >= 0 THEN ROUND({x} / POW(10.0, {e}), {d}) * POW(10.0, {e}) "
           f"ELSE ROUND({x} * POW(10.0, -{e}), {d}) / POW(10.0, -{e}) END")
    return f"(({sig}) + 0.0)"


# ---- derived fixtures (same expression in the query and in the oracle) ----
def li_with_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with injected nulls (by integer key), an all-null and an unnamed column."""
    li = tbl(spark, sf, "lineitem")
    return (li.withColumn("l_quantity", F.when(F.col("l_orderkey") % 17 != 0, F.col("l_quantity")))
            .withColumn("l_discount", F.when(F.col("l_orderkey") % 5 != 0, F.col("l_discount")))
            .withColumn("empty_col", F.lit(None).cast("double"))
            .withColumn("Unnamed: 32", F.lit(1)))


SQL_LI_NULLS = ("lin AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
                "CASE WHEN l_orderkey % 17 <> 0 THEN l_quantity END AS l_quantity, l_extendedprice, "
                "CASE WHEN l_orderkey % 5 <> 0 THEN l_discount END AS l_discount, l_tax, l_returnflag, "
                "l_linestatus, l_shipdate, CAST(NULL AS DOUBLE) AS empty_col, 1 AS \"Unnamed: 32\" FROM lineitem)")
LIN_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "empty_col", "Unnamed: 32"]


def li_priced(spark: SparkSession, sf: str) -> DataFrame:
    li = tbl(spark, sf, "lineitem")
    dp = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.withColumn("disc_price", dp).withColumn("charge", dp * (1 + F.col("l_tax"))) \
        .withColumn("target", (F.col("l_returnflag") == "A").cast("int"))


SQL_LI_PRICED = ("lp AS (SELECT *, l_extendedprice * (1 - l_discount) AS disc_price, "
                 "l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge, "
                 "CAST(l_returnflag = 'A' AS INTEGER) AS target FROM lineitem)")
LP_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "disc_price", "charge"]


def sql_melt(source: str, cols: list[str], keep: list[str] = ()) -> str:
    """UNION ALL melt of columns to (keep..., feature, value double)."""
    k = "".join(f"{c}, " for c in keep)
    return sql_union([f"SELECT {k}'{c}' AS feature, CAST(\"{c}\" AS DOUBLE) AS value FROM {source}"
                      for c in cols])


def sql_quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


# ---- scored lineitem: fixed linear scorer (G3) and a label with md5 noise ----
# z = b + w . x over (l_quantity, l_discount, l_tax); score = 1 / (1 + exp(-z));
# label = z + 3 * (u - 0.5) > 0 with u uniform from the row key; prediction = score >= 0.5
SCORE_B = -3.3
SCORE_W = (("l_quantity", 0.08), ("l_discount", 20.0), ("l_tax", 10.0))
NOISE_SEED = 7


def li_scored(spark: SparkSession, sf: str, sides: bool = True) -> DataFrame:
    from veritab.functions.scalar import uniform_hash
    from veritab.operators.score import linear_score
    li = tbl(spark, sf, "lineitem")
    z = sum((F.col(c) * w for c, w in SCORE_W), F.lit(SCORE_B))
    u = uniform_hash(*LI_KEY, seed=NOISE_SEED)
    # score rounded to 9 digits: equal scores must stay equal across engines (float ties)
    out = (li.withColumn("score", F.round(linear_score(dict(SCORE_W), SCORE_B), 9))
           .withColumn("label", ((z + 3 * (u - 0.5)) > 0).cast("int"))
           .withColumn("prediction", (F.col("score") >= 0.5).cast("int")))
    if sides:
        out = out.withColumn("side", F.when(li_is_reference(), "reference").otherwise("current"))
    return out


_Z_SQL = f"({SCORE_B} + " + " + ".join(f"{c} * {w}" for c, w in SCORE_W) + ")"
_U_SQL = (f"(('0x' || substr(md5(concat_ws('|', {', '.join(LI_KEY)}, '{NOISE_SEED}')), 1, 8))::BIGINT / 2^32)")
SQL_LI_SCORED = (f"ls AS (SELECT *, ROUND(1.0 / (1.0 + EXP(-{_Z_SQL})), 9) AS score, "
                 f"CAST({_Z_SQL} + 3 * ({_U_SQL} - 0.5) > 0 AS INTEGER) AS label, "
                 f"CAST(ROUND(1.0 / (1.0 + EXP(-{_Z_SQL})), 9) >= 0.5 AS INTEGER) AS prediction, "
                 f"CASE WHEN l_shipdate < TIMESTAMP '{REF_CUTOFF}' THEN 'reference' ELSE 'current' END AS side "
                 "FROM lineitem)")


def sql_ks_pvalue(d: str, n: str, m: str) -> str:
    lam = f"({d} * SQRT({n} * {m} * 1.0 / ({n} + {m})))"
    small = (f"1.0 - SQRT(2 * PI()) / {lam} * list_sum(list_transform(range(1, 101), "
             f"lambda k: EXP(-((2 * k - 1) * (2 * k - 1)) * PI() * PI() / (8 * {lam} * {lam}))))")
    large = (f"2.0 * list_sum(list_transform(range(1, 101), lambda k: "
             f"(CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * EXP(-2.0 * k * k * {lam} * {lam})))")
    p = f"(CASE WHEN {lam} <= 0 THEN 1.0 WHEN {lam} < 1.18 THEN {small} ELSE {large} END)"
    return f"LEAST(1.0, GREATEST(0.0, {p}))"


def sql_chi2_sf(x: str, k: str) -> str:
    a, y = f"({k} / 2.0)", f"({x} / 2.0)"
    series = (f"list_sum(list_transform(range(0, 2001), lambda n: "
              f"EXP(-{y} + ({a} + n) * LN({y}) - LGAMMA({a} + n + 1))))")
    p = (f"(CASE WHEN {k} <= 0 THEN 1.0 WHEN {x} <= 0 THEN 1.0 "
         f"WHEN {y} > {a} + 10.0 * SQRT({a}) + 100.0 THEN 0.0 ELSE 1.0 - {series} END)")
    return f"LEAST(1.0, GREATEST(0.0, {p}))"


# ---- drifted sides: current = rows selected on two features, so drift is real ----
def li_drifted(spark: SparkSession, sf: str) -> DataFrame:
    li = tbl(spark, sf, "lineitem")
    cur = (F.col("l_quantity") > 30) | (F.col("l_discount") > 0.06)
    dp = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (li.withColumn("disc_price", dp)
            .withColumn("side", F.when(cur, "current").otherwise("reference")))


SQL_LI_DRIFTED = ("ld AS (SELECT *, l_extendedprice * (1 - l_discount) AS disc_price, "
                  "CASE WHEN l_quantity > 30 OR l_discount > 0.06 THEN 'current' ELSE 'reference' END AS side "
                  "FROM lineitem)")
LD_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "disc_price"]
