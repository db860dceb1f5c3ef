"""The EDA report as one long table ``(section, item, value)``: shape, class counts
and shares, total missing cells, IQR outliers per feature and the top correlations with
the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.operators import profile as P
from veritab.operators.report import union_all


def eda_report(df: DataFrame, target: str, target01: Column, numeric: Sequence[str], top: int = 5) -> DataFrame:
    def long(frame, section, item, value):
        return frame.select(F.lit(section).alias("section"), F.col(item).cast("string").alias("item"),
                            F.col(value).cast("double").alias("value"))
    shape = P.shape(df)
    parts = [
        shape.select(F.lit("shape").alias("section"), F.lit("rows").alias("item"), F.col("n_rows").cast("double").alias("value")),
        shape.select(F.lit("shape").alias("section"), F.lit("columns").alias("item"),
                     F.col("n_columns").cast("double").alias("value")),
        long(P.class_shares(df, target), "class_count", target, "n"),
        long(P.class_shares(df, target), "class_share", target, "percent"),
        long(P.missing_values(df).where(F.col("column_name") == "__total__"), "missing", "column_name", "missing"),
        long(P.outlier_counts(df, numeric), "outliers", "feature", "outliers"),
        long(P.target_correlation(df.withColumn("_t", target01), numeric, F.col("_t"), top), "top_correlation",
             "feature", "corr"),
    ]
    return union_all(parts)
