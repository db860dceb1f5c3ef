"""Projection, filter and schema operators."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from veritab.functions.scalar import col_of


def non_null_counts(df: DataFrame) -> DataFrame:
    """One aggregate: non-null count of every column (one row, one number per column)."""
    return df.agg(*[F.count(col_of(c)).alias(c) for c in df.columns])


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns that hold no value. The decision needs one aggregate row
    (bounded by the schema width), read back to build the new projection."""
    counts = non_null_counts(df).first().asDict()
    return df.drop(*[c for c, n in counts.items() if n == 0])


def drop_name_pattern(df: DataFrame, pattern: str = "Unnamed") -> DataFrame:
    """Drop columns whose name contains ``pattern``."""
    return df.drop(*[c for c in df.columns if pattern in c])


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Keep numeric columns, minus the excluded (key) ones."""
    keep = [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]
    return df.select(*[col_of(c) for c in keep])


def columns_containing(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Keep columns whose name contains any of ``parts``."""
    return df.select(*[col_of(c) for c in df.columns if any(p in c for p in parts)])


def columns_matching(df: DataFrame, regex: str) -> DataFrame:
    """P4 (regex form)."""
    r = re.compile(regex)
    return df.select(*[col_of(c) for c in df.columns if r.search(c)])


def project_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """P5: the wanted columns that exist, in the wanted order; absent ones ignored."""
    have = set(df.columns)
    return df.select(*[col_of(c) for c in wanted if c in have])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Projection by exclusion."""
    return df.drop(*cols)


def outside_fences(df: DataFrame, col: str, lower: Column, upper: Column) -> DataFrame:
    """Rows with ``col < lower OR col > upper`` (bounds may be scalar subqueries)."""
    x = col_of(col)
    return df.where((x < lower) | (x > upper))


def iqr_outlier_rows(df: DataFrame, col: str, factor: float = 1.5) -> DataFrame:
    """P7 with fences from exact quartiles; the fences are one scalar subquery."""
    from veritab.operators.profile import iqr_fences
    f = iqr_fences(df, [col], factor=factor).select(F.struct("lower", "upper").alias("b")).scalar()
    return outside_fences(df, col, f.getField("lower"), f.getField("upper"))


def misclassified(df: DataFrame, label: str, pred: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows with ``label != prediction``."""
    out = df.where(col_of(label) != col_of(pred))
    return out.select(*[col_of(c) for c in keep]) if keep else out


def filter_class(df: DataFrame, target: str, value) -> DataFrame:
    """Rows of one class."""
    return df.where(col_of(target) == F.lit(value))


def metric_rows_over(df: DataFrame, value_col: str, limit: float) -> DataFrame:
    """P10: keep metric rows whose value is over a limit."""
    return df.where(col_of(value_col) > limit)


def all_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Whether every value of ``col`` is in ``values`` (``isin`` reduced by ``bool_and``)."""
    return df.agg(F.coalesce(F.bool_and(col_of(col).isin(list(values))), F.lit(True)).alias("passed"))


def drop_nulls(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with null in ``subset``."""
    return df.dropna(subset=list(subset))


def verify_dataset(df: DataFrame, target: str, valid: Sequence) -> DataFrame:
    """Five checks as rows ``(check, passed)`` plus their conjunction ``all``:
    rows > 0, columns > 0, no missing cell, target present, target values valid."""
    has_target = target in df.columns
    aggs = [F.count(F.lit(1)).alias("n"),
            sum((F.count_if(col_of(c).isNull()) for c in df.columns), F.lit(0)).alias("missing")]
    if has_target:
        aggs.append(F.coalesce(F.bool_and(col_of(target).isin(list(valid))), F.lit(True)).alias("valid"))
    one = df.agg(*aggs)
    valid_c = F.col("valid") if has_target else F.lit(False)
    checks = [("rows", F.col("n") > 0), ("columns", F.lit(len(df.columns) > 0)),
              ("no_missing", F.col("missing") == 0), ("target_present", F.lit(has_target)),
              ("target_values", valid_c)]
    conj = checks[0][1]
    for _, c in checks[1:]:
        conj = conj & c
    checks.append(("all", conj))
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), c.alias("passed"))
                                         for n, c in checks])))


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows under an explicit order (Spark rows have no index)."""
    return df.orderBy(*[col_of(c) for c in order]).limit(n)


def missing_required(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required minus present columns (schema only)."""
    have = set(df.columns)
    return [c for c in required if c not in have]


def column_listing(df: DataFrame) -> DataFrame:
    """Columns of a frame with their position and non-null count (one aggregate):
    a compact check of a projection's outcome."""
    counts = df.agg(*[F.count(col_of(c)).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    return counts.select(F.inline(F.array(*[F.struct(
        F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("non_null"))
        for i, c in enumerate(df.columns)])))
