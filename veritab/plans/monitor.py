"""Batch monitoring run (B1, B2): every requested check over one side-tagged table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.operators.drift import cv_drift_check
from veritab.operators.quality import quality_percent_check
from veritab.operators.report import run_agg_checks, union_all
from veritab.roles import Roles


def tag_sides(reference: DataFrame, current: DataFrame, side_col: str = "side") -> DataFrame:
    """Reference and current as one table with a ``side`` column (schemas aligned by name)."""
    return (reference.withColumn(side_col, F.lit("reference"))
            .unionByName(current.withColumn(side_col, F.lit("current")), allowMissingColumns=True))


def split_sides(df: DataFrame, is_reference: Column, side_col: str = "side") -> DataFrame:
    """One table cut into sides by a predicate (e.g. a date)."""
    return df.withColumn(side_col, F.when(is_reference, F.lit("reference")).otherwise(F.lit("current")))


def run_checks(tagged: DataFrame, roles: Roles, checks: Sequence[str] = ("data_quality", "drift"),
               side_col: str = "side", extra: Sequence[DataFrame] = ()) -> DataFrame:
    """B1: data quality + CV drift in one scan and one aggregate; long report rows.

    B2 (``checks`` including ``performance``) adds the per-side classifier metrics; those
    are computed by :mod:`veritab.operators.evaluate` and passed in ``extra``.
    """
    agg_checks = []
    if "data_quality" in checks:
        agg_checks.append(quality_percent_check(tagged.columns, side_col=side_col))
    if "drift" in checks:
        agg_checks.append(cv_drift_check(list(roles.numeric), side_col))
    parts = [run_agg_checks(tagged, agg_checks)] if agg_checks else []
    parts += list(extra)
    return union_all(parts)
