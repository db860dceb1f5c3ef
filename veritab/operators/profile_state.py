"""Profiles that add up: mergeable states of columns (Q6, A5, A12, D4, B1 over any range of days).

A state is one row per (partition, column): counts, mean and sum of squares about it, extremes, a quantile sketch (KLL),
a distinct sketch (HyperLogLog) and a heavy-hitter sketch. A day is read once; the profile of any range of days is the merge of
its states and reads no row of the data again. Merging states gives states, in any grouping and order.

Exact after any merge: rows, missing, count, mean, std, minimum, maximum, co-moments (up to the rounding of sums). The sketches
carry their bounds (:func:`profile_of`): the rank error of a quantile and the relative error of a distinct count hold with the
probability that their docstring names; values of a heavy-hitter sketch that never had to drop one are exact.

A state has bounded size whatever the number of rows (about 16 KiB of quantiles, 4 KiB of distinct hashes, at most
``TRACKED`` values), and all aggregates merge map-side, so a partition with a third of all rows is no hot task.

Null and NaN are missing; -0.0 counts as 0.0. A column without values has a state with count 0 and a profile of nulls.
An empty table has no states, and no states have no profile. Columns of ``by`` must not be named like a column of the state.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.functions.scalar import col_of
from veritab.operators.drift import cv_drift_check
from veritab.operators.quality import quality_percent_check
from veritab.operators.report import rows_from
from veritab.session import spread

#: Size parameter of the quantile sketch, log2 of the registers of the distinct sketch, values a heavy-hitter sketch tracks.
QUANTILES, REGISTERS, TRACKED = 1024, 12, 1_000
#: Pairs of columns in one aggregate of :func:`pair_states`.
PAIRS = 120

#: Columns of a state after those of ``by``.
STATE = ("feature", "kind", "n_rows", "count", "mean", "m2", "min", "max", "quantiles", "distinct", "top")
PAIR = ("feature_a", "feature_b", "count", "mean_a", "mean_b", "m2_a", "m2_b", "comoment")


def rank_error(size: int = QUANTILES) -> float:
    """Largest rank error of one quantile, as a share of the rows, that a KLL sketch keeps with probability 0.99
    (published fit of its authors)."""
    return 2.296 / size ** 0.9723


def distinct_error(registers: int = REGISTERS) -> float:
    """Relative standard error of a merged distinct sketch."""
    return 1.04 / math.sqrt(1 << registers)


def top_error(tracked: int = TRACKED) -> float:
    """Largest error of a heavy hitter's count, as a share of all counted rows: 3.5 over the width of the sketch's table, the next
    power of two that holds ``tracked`` at a load of 3/4."""
    return 3.5 / (1 << math.ceil(math.log2(tracked / 0.75)))


def _number(c: str) -> Column:
    x = col_of(c).cast("double") + F.lit(0.0)  # -0.0 becomes 0.0
    return F.when(~F.isnan(x), x)


def _state(i: int, name: str, numeric: bool) -> Column:
    c = F.lit(name).alias("feature"), F.lit("numeric" if numeric else "categorical").alias("kind")
    none = F.lit(None)
    moments = [F.col(f"_{k}{i}") if numeric else none.cast("double") for k in ("mean", "m2", "min", "max")]
    return F.struct(*c, F.col("_rows").alias("n_rows"), F.col(f"_count{i}").alias("count"),
                    *[m.alias(k) for m, k in zip(moments, ("mean", "m2", "min", "max"))],
                    (F.col(f"_quantiles{i}") if numeric else none.cast("binary")).alias("quantiles"),
                    F.col(f"_distinct{i}").alias("distinct"), F.col(f"_top{i}").alias("top"))


def _top(text: str, tracked: int) -> Column:
    return F.expr(f"approx_top_k_accumulate({text}, {tracked}) FILTER (WHERE {text} IS NOT NULL)")


def column_states(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], by: Sequence[str]) -> DataFrame:
    """States of all columns per group of ``by``: one scan, one aggregate, no melt."""
    by, numeric, categorical = list(by), list(numeric), list(categorical)
    cols = [(c, True) for c in numeric] + [(c, False) for c in categorical]
    src = spread(df).select(*[col_of(b) for b in by],
                    *[(_number(c) if num else col_of(c).cast("string")).alias(f"_v{i}") for i, (c, num) in enumerate(cols)])
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (_, num) in enumerate(cols):
        v, text = F.col(f"_v{i}"), f"CAST(_v{i} AS STRING)"
        aggs += [F.count(v).alias(f"_count{i}"), _top(text, TRACKED).alias(f"_top{i}"),
                 F.hll_sketch_agg(v.cast("string"), F.lit(REGISTERS)).alias(f"_distinct{i}")]
        if num:
            aggs += [F.avg(v).alias(f"_mean{i}"), (F.var_pop(v) * F.count(v)).alias(f"_m2{i}"), F.min(v).alias(f"_min{i}"),
                     F.max(v).alias(f"_max{i}"), F.kll_sketch_agg_double(v, F.lit(QUANTILES)).alias(f"_quantiles{i}")]
    one = src.groupBy(*[col_of(b) for b in by]).agg(*aggs)
    return one.select(*[col_of(b) for b in by], F.inline(F.array(*[_state(i, c, num) for i, (c, num) in enumerate(cols)])))


def _moved(n: str, mean: str, of: str) -> Column:
    """Square (or product) about the merged mean that a part's own mean adds."""
    return F.col(n) * (F.col(mean) - F.col(of)) * (F.col(mean) - F.col(of))


def _with_means(parts: DataFrame, means: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every part with the merged means of its group; a null key is a group."""
    means = means.withColumnsRenamed({k: f"_of_{i}" for i, k in enumerate(keys)})
    same = [col_of(k).eqNullSafe(F.col(f"_of_{i}")) for i, k in enumerate(keys)]
    return parts.join(means, same).drop(*[f"_of_{i}" for i in range(len(keys))])


def merge_states(states: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """States of the groups of ``keep`` from those of any finer partition. Means are merged first, from narrow columns only,
    then squares about the merged mean (Chan, Golub and LeVeque): nothing is subtracted from a large sum."""
    keys = [*keep, "feature", "kind"]
    mean = F.try_divide(F.sum(F.when(F.col("count") > 0, F.col("count") * F.col("mean"))), F.sum("count")).alias("_mean")
    merged = _with_means(states, states.groupBy(*keys).agg(mean), keys).groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("count").alias("count"), F.first("_mean").alias("mean"),
        F.sum(F.when(F.col("count") > 0, F.col("m2") + _moved("count", "mean", "_mean"))).alias("m2"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles", F.lit(QUANTILES)).alias("_quantiles"),
        F.hll_union_agg("distinct").alias("distinct"), F.expr(f"approx_top_k_combine(top, {TRACKED})").alias("top"))
    quantiles = F.when(F.col("kind") == "numeric", F.col("_quantiles")).alias("quantiles")
    return merged.select(*keep, *[quantiles if c == "quantiles" else F.col(c) for c in STATE])


def profile_of(states: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Q6 from states: per (keep, feature) count, missing, distinct, mode and its count, mean, std, min, quartiles, max, and the
    bounds of what sketches give: ``distinct_error`` (one standard error, in values), ``mode_error`` (rows; 0 where no value had to
    be dropped: fewer distinct values than ``TRACKED`` by more than ten standard errors) and ``rank_error`` (share of rows, probability 0.99). Equal counts: the
    smallest value, by number for numeric columns."""
    top = F.expr(f"approx_top_k_estimate(top, {TRACKED})")
    some, number = F.col("count") > 0, F.col("kind") == "numeric"
    best = F.array_max(F.transform("_top", lambda t: t["count"]))
    ties = F.filter("_top", lambda t: t["count"] == F.col("mode_count"))
    text = F.array_min(F.transform(ties, lambda t: t["item"]))
    smallest = F.array_min(F.transform(ties, lambda t: t["item"].cast("double")))
    quantile = lambda p: F.when(number & some, F.kll_sketch_get_quantile_double("quantiles", F.lit(p)))
    few = F.col("distinct") * (1 + 10 * distinct_error()) < TRACKED
    out = states.withColumns({"_top": top, "missing": F.col("n_rows") - F.col("count")})
    out = out.withColumns({"mode_count": best, "distinct": F.hll_sketch_estimate("distinct"),
                           **{f"q{int(p * 100)}": quantile(p) for p in (0.25, 0.5, 0.75)}})
    return out.select(*keep, "feature", "count", "missing", "distinct", (F.col("distinct") * distinct_error()).alias("distinct_error"),
                      F.when(~number, text).alias("mode_text"), F.when(number, smallest).alias("mode_num"), "mode_count",
                      F.when(few, F.lit(0.0)).otherwise(F.col("count") * top_error()).alias("mode_error"), "mean",
                      F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1))).alias("std"), "min", "q25", "q50", "q75", "max",
                      F.when(number, F.lit(rank_error())).alias("rank_error"))


def pair_states(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Co-moments of every pair of columns over the rows that have both, per group of ``by``; one scan per ``PAIRS`` pairs."""
    cols, by = list(cols), list(by)
    src = spread(df).select(*[col_of(b) for b in by], *[_number(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    out = None
    for at in range(0, len(pairs), PAIRS):
        aggs, structs = [], []
        for i, j in pairs[at:at + PAIRS]:
            a, b = (F.when(F.col(f"_v{i}").isNotNull() & F.col(f"_v{j}").isNotNull(), F.col(f"_v{k}")) for k in (i, j))
            t, n = f"{i}_{j}", F.count(a)
            aggs += [n.alias(f"_n{t}"), F.avg(a).alias(f"_a{t}"), F.avg(b).alias(f"_b{t}"), (F.var_pop(a) * n).alias(f"_aa{t}"),
                     (F.var_pop(b) * n).alias(f"_bb{t}"), (F.covar_pop(a, b) * n).alias(f"_ab{t}")]
            structs.append(F.struct(F.lit(cols[i]).alias("feature_a"), F.lit(cols[j]).alias("feature_b"),
                                    *[F.col(f"_{k}{t}").alias(name) for k, name in zip(("n", "a", "b", "aa", "bb", "ab"), PAIR[2:])]))
        part = src.groupBy(*[col_of(b) for b in by]).agg(*aggs).select(*[col_of(b) for b in by], F.inline(F.array(*structs)))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no columns")
    return out


def merge_pairs(pairs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Co-moments of the groups of ``keep`` from those of any finer partition."""
    keys, some = [*keep, "feature_a", "feature_b"], F.col("count") > 0
    means = pairs.groupBy(*keys).agg(*[F.try_divide(F.sum(F.when(some, F.col("count") * F.col(m))), F.sum("count")).alias(f"_{m}")
                                       for m in ("mean_a", "mean_b")])
    product = F.col("count") * (F.col("mean_a") - F.col("_mean_a")) * (F.col("mean_b") - F.col("_mean_b"))
    return _with_means(pairs, means, keys).groupBy(*keys).agg(
        F.sum("count").alias("count"), F.first("_mean_a").alias("mean_a"), F.first("_mean_b").alias("mean_b"),
        F.sum(F.when(some, F.col("m2_a") + _moved("count", "mean_a", "_mean_a"))).alias("m2_a"),
        F.sum(F.when(some, F.col("m2_b") + _moved("count", "mean_b", "_mean_b"))).alias("m2_b"),
        F.sum(F.when(some, F.col("comoment") + product)).alias("comoment"))


def correlations_of(pairs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """A12 from co-moments: the long correlation matrix, both triangles; null where a column does not vary."""
    varies = (F.col("m2_a") > 0) & (F.col("m2_b") > 0)
    r = F.when(varies, F.when(F.col("feature_a") == F.col("feature_b"), F.lit(1.0))
               .otherwise(F.col("comoment") / (F.sqrt("m2_a") * F.sqrt("m2_b"))))
    half = pairs.select(*keep, "feature_a", "feature_b", r.alias("corr"))
    other = half.where(F.col("feature_a") != F.col("feature_b"))
    return half.unionByName(other.select(*keep, F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"), "corr"))


def checks_of(states: DataFrame, columns: Sequence[str], features: Sequence[str], side_col: str = "side") -> DataFrame:
    """B1 from states that are merged per side: the report rows of the quality and the CV drift check, by the checks' own
    rules. ``columns``: the columns whose cells the quality check counts; all of them have states."""
    states = states.where(F.col("feature").isin(list(columns)))
    sides = ("reference", "current")
    aggs = []
    for s in sides:
        own = F.col(side_col) == s
        aggs += [F.coalesce(F.max(F.when(own, F.col("n_rows"))), F.lit(0)).alias(f"_q4_rows_{s}"),
                 F.sum(F.when(own, F.col("n_rows") - F.col("count"))).alias(f"_q4_null_{s}")]
        for i, f in enumerate(features):
            hit = own & (F.col("feature") == f)
            std = F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1)))
            aggs += [F.coalesce(F.max(F.when(hit, F.col("count"))), F.lit(0)).alias(f"_d4_n_{s}_{i}"),
                     F.max(F.when(hit, F.col("mean"))).alias(f"_d4_m_{s}_{i}"), F.max(F.when(hit, std)).alias(f"_d4_sd_{s}_{i}")]
    checks = [quality_percent_check(columns, sides, side_col), cv_drift_check(list(features), side_col)]
    return rows_from(states.agg(*aggs), [x for c in checks for x in c.finish()])


def save_states(states: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Writes states in folders of their partition. Partitions that ``states`` holds are replaced as a whole, others stay, so a
    repeated run, or one that follows a killed one, leaves one copy."""
    (states.repartition(*[col_of(c) for c in partition_by]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def load_states(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """States of the partitions that meet ``where``; other folders are not read."""
    states = spark.read.parquet(path)
    return states if where is None else states.where(where)
