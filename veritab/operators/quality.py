"""Data-quality operators (Q1-Q8, A4, A10 and friends)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from veritab import thresholds as T
from veritab.functions.scalar import col_of, quality_band
from veritab.operators.profile import row_hashes
from veritab.operators.report import AggCheck, row, rows_from, run_agg_checks
from veritab.roles import Roles


def _null_cells(cols: Sequence[str], cond: Column | None = None) -> Column:
    parts = [F.when(col_of(c).isNull(), 1).otherwise(0) for c in cols]
    total = sum(parts[1:], parts[0]) if parts else F.lit(0)
    return F.sum(total if cond is None else F.when(cond, total))


def quality_percent_check(columns: Sequence[str], sides: Sequence[str] = ("reference", "current"),
                          side_col: str = "side", th: T.Thresholds = T.DEFAULT) -> AggCheck:
    """Q4: per side, total rows, missing share of all cells in percent,
    score ``max(0, 100 - missing%)``, band and the configured limit in percent."""
    cols = [c for c in columns if c != side_col]
    aggs, names = [], {}
    for s in sides:
        cond = F.col(side_col) == s
        aggs += [F.count_if(cond).alias(f"_q4_rows_{s}"), _null_cells(cols, cond).alias(f"_q4_null_{s}")]

    def finish() -> list:
        structs = []
        for s in sides:
            rows_c, null_c = F.col(f"_q4_rows_{s}"), F.coalesce(F.col(f"_q4_null_{s}"), F.lit(0))
            pct = F.when(rows_c > 0, null_c / (rows_c * F.lit(len(cols))) * 100)
            score = F.greatest(F.lit(0.0), F.lit(100.0) - pct)
            structs += [
                row("data_quality", s, None, "total_rows", rows_c),
                row("data_quality", s, None, "missing_percentage", pct),
                row("data_quality", s, None, "quality_score", score, quality_band(score)),
                row("data_quality", s, None, "threshold", th.missing_values * 100),
            ]
        return structs

    return AggCheck("data_quality", aggs, finish)


def quality_percent(df: DataFrame, side_col: str | None = None) -> DataFrame:
    """Q4 on one table (``side_col=None``) or on a side-tagged table."""
    if side_col is None:
        df = df.withColumn("side", F.lit("current"))
        return run_agg_checks(df, [quality_percent_check(df.columns, ("current",))])
    return run_agg_checks(df, [quality_percent_check(df.columns, side_col=side_col)])


def structure_validation(df: DataFrame, roles: Roles,
                         missing_limit: float = T.MISSING_VALUES_THRESHOLD) -> DataFrame:
    """Q1: issue rows ``(issue, column_name, value)``: required columns absent (W4), declared
    numeric columns that are not numeric, columns whose missing share is over the limit."""
    from veritab.operators.shape import missing_required
    spark = df.sparkSession
    absent = missing_required(df, roles.required)
    types = {f.name: f.dataType for f in df.schema.fields}
    non_numeric = [c for c in roles.numeric if c in types and not isinstance(types[c], NumericType)]
    present = [c for c in roles.required if c in types]
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(col_of(c).isNull()).alias(f"_m{i}") for i, c in enumerate(present)])
    structs = [F.struct(F.lit("missing_column").alias("issue"), F.lit(c).alias("column_name"),
                        F.lit(None).cast("double").alias("value")) for c in absent]
    structs += [F.struct(F.lit("non_numeric").alias("issue"), F.lit(c).alias("column_name"),
                         F.lit(None).cast("double").alias("value")) for c in non_numeric]
    structs += [F.struct(F.lit("missing_share").alias("issue"), F.lit(c).alias("column_name"),
                         F.try_divide(F.col(f"_m{i}"), F.col("_n")).alias("value")) for i, c in enumerate(present)]
    long = one.select(F.inline(F.array(*structs)))
    return long.where((F.col("issue") != "missing_share") | (F.col("value") > missing_limit))


def dataset_summary(tagged: DataFrame, side_col: str = "side",
                    sides: Sequence[str] = ("reference", "current")) -> DataFrame:
    """Q2: per side rows, columns, missing cells, missing share of all cells, duplicate rows
    (copies after the first) and duplicate share."""
    cols = [c for c in tagged.columns if c != side_col]
    nulls = sum((F.when(col_of(c).isNull(), 1).otherwise(0) for c in cols), F.lit(0))
    g = tagged.groupBy(F.col(side_col), *row_hashes(cols)).agg(
        F.count(F.lit(1)).alias("_c"), F.max(nulls).alias("_nulls"))
    per = g.groupBy(side_col).agg(F.sum("_c").alias("n_rows"),
                                  F.sum(F.col("_c") * F.col("_nulls")).alias("missing_cells"),
                                  F.sum(F.col("_c") - 1).alias("duplicates"))
    return per.select(side_col, "n_rows", F.lit(len(cols)).alias("n_columns"), "missing_cells",
                      F.try_divide(F.col("missing_cells"), F.col("n_rows") * len(cols)).alias("missing_share"),
                      "duplicates", (F.col("duplicates") / F.col("n_rows")).alias("duplicate_share"))


def quality_score(tagged: DataFrame, side_col: str = "side") -> DataFrame:
    """Q3: mean of ``1 - missing share`` and ``1 - duplicate share`` per side; 0.8 when the
    side has rows but neither share is available."""
    s = dataset_summary(tagged, side_col)
    parts = [F.when(F.col("missing_share").isNotNull(), 1 - F.col("missing_share")),
             F.when(F.col("duplicate_share").isNotNull(), 1 - F.col("duplicate_share"))]
    n = sum((F.when(p.isNotNull(), 1).otherwise(0) for p in parts), F.lit(0))
    tot = sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0))
    score = F.when(n > 0, tot / n).when(F.col("n_rows") > 0, F.lit(T.QUALITY_SCORE_DEFAULT))
    return s.select(side_col, "missing_share", "duplicate_share", score.alias("quality_score"))


def stability(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Q5: rows whose identical feature values carry more than one target value.
    ``count_distinct`` is planned as two aggregates, so hot groups are merged map-side."""
    g = df.groupBy(*[col_of(c) for c in features]).agg(
        F.count(F.lit(1)).alias("_c"), F.count_distinct(col_of(target)).alias("_t"))
    return g.agg(F.sum("_c").alias("n_rows"),
                 F.coalesce(F.sum(F.when(F.col("_t") > 1, F.col("_c"))), F.lit(0)).alias("unstable_rows")) \
        .withColumn("share", F.col("unstable_rows") / F.col("n_rows"))
