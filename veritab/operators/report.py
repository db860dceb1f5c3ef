"""Long metric table helpers.

Reports are rows ``(check, side, feature, metric, value double, status string)``; nested
JSON is produced only at the sink (``sources.report_json``). Checks that need only
algebraic aggregates share one scan: each declares its aggregate expressions and a
``finish`` step over the one-row result (see :func:`run_agg_checks`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ("check", "side", "feature", "metric", "value", "status")


def row(check: str, side: str | None, feature: str | None, metric: str, value,
        status=None) -> Column:
    """One report row as a struct (used with :func:`rows_from`)."""
    v = value if isinstance(value, Column) else F.lit(value)
    s = status if isinstance(status, Column) else F.lit(status)
    return F.struct(F.lit(check).alias("check"), F.lit(side).cast("string").alias("side"),
                    F.lit(feature).cast("string").alias("feature"), F.lit(metric).alias("metric"),
                    v.cast("double").alias("value"), s.cast("string").alias("status"))


def rows_from(df: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Turn each input row into several report rows (``inline`` generator, no shuffle)."""
    return df.select(F.inline(F.array(*structs)))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


@dataclass
class AggCheck:
    """A check made of aggregate expressions plus report-row structs over their results."""
    name: str
    aggs: list[Column]
    finish: Callable[[], list[Column]]


def run_agg_checks(df: DataFrame, checks: Sequence[AggCheck]) -> DataFrame:
    """Evaluate all checks with ONE aggregate over ``df`` (partial aggregation per task,
    a single small final merge), then expand the one result row to report rows."""
    one = df.agg(*[a for c in checks for a in c.aggs])
    return rows_from(one, [s for c in checks for s in c.finish()])
