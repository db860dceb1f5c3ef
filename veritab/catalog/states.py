"""Profiles from mergeable monthly states: Q6, A12 and B1 without a second look at the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritab.catalog.base import (LI_CATEGORICAL, LI_NUMERIC, REF_CUTOFF, SQL_LI_SIDES, LP_NUMERIC,
                                  li_priced, lineitem_sides, query, rounded, sql_round, sql_union, tbl)
from veritab.catalog.monitoring import _LI_COLS, REGISTRY_SQL
from veritab.catalog.profiles import _corr_sql
from veritab.operators import profile as P
from veritab.operators import profile_state as S
from veritab.session import run_table

R = sql_round

#: Rank errors that the check allows: a sketch keeps one with probability 0.99, 2.5 of them but for about one case in 10^9.
SURE = 2.5
#: Standard errors of a distinct count that the check allows.
FAR = 6


def _monthly(df):
    return df.withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))


def _by_side(states):
    """States of both sides; months before the cutoff are the reference."""
    side = F.when(F.col("month") < F.lit(REF_CUTOFF[:7]), "reference").otherwise("current")
    return S.merge_states(states.withColumn("side", side), ["side"])


def _states(spark, sf, numeric, categorical):
    return run_table(S.column_states(_monthly(tbl(spark, sf, "lineitem")), numeric, categorical, ["month"]))


def _profile_sql():
    parts = []
    for c in [*LI_NUMERIC, *LI_CATEGORICAL]:
        num = c in LI_NUMERIC
        own = lambda e: R(e) if num else "CAST(NULL AS DOUBLE)"  # noqa: B023,E731
        few = f"d * (1 + 10 * 1.04 / 64) < {S.TRACKED}"
        parts.append(
            f"SELECT a.side, '{c}' AS feature, a.count, a.missing, CASE WHEN {few} THEN d END AS distinct, "
            f"{f'CASE WHEN {few} THEN m.mode END' if not num else 'CAST(NULL AS VARCHAR)'} AS mode_text, "
            f"{f'CASE WHEN {few} THEN m.mode END' if num else 'CAST(NULL AS DOUBLE)'} AS mode_num, "
            f"CASE WHEN {few} THEN m.mode_count END AS mode_count, a.mean, a.std, a.min, a.max FROM "
            f"(SELECT side, COUNT({c}) AS count, COUNT(*) - COUNT({c}) AS missing, COUNT(DISTINCT {c}) AS d, "
            f"{own(f'AVG({c})' if num else '')} AS mean, {own(f'STDDEV_SAMP({c})' if num else '')} AS std, "
            f"{own(f'MIN({c})' if num else '')} AS min, {own(f'MAX({c})' if num else '')} AS max FROM li GROUP BY side) a JOIN "
            f"(SELECT side, ARG_MIN(v, (-n, v)) AS mode, MAX(n) AS mode_count FROM "
            f"(SELECT side, {c} AS v, COUNT(*) AS n FROM li WHERE {c} IS NOT NULL GROUP BY side, {c}) GROUP BY side) m ON a.side = m.side")
    return f"WITH {SQL_LI_SIDES}\n{sql_union(parts)}"


@query("q06_profile_from_states", _profile_sql())
def q06_profile_from_states(spark, sf):
    """Q6 per side from monthly states. Distinct count and mode are given where the sketches hold every value."""
    p = S.profile_of(_by_side(_states(spark, sf, LI_NUMERIC, LI_CATEGORICAL)), ["side"])
    exact = F.col("mode_error") == 0
    return rounded(p.select("side", "feature", "count", "missing", *[F.when(exact, F.col(c)).alias(c) for c in
                            ("distinct", "mode_text", "mode_num", "mode_count")], "mean", "std", "min", "max"))


_BOUNDS_SQL = f"WITH {SQL_LI_SIDES}\n" + sql_union([
    f"SELECT side, '{c}' AS feature, '{m}' AS measure, {R(e)} AS exact, TRUE AS within FROM li GROUP BY side"
    for c in LI_NUMERIC for m, e in (("q25", f"QUANTILE_CONT({c}, 0.25)"), ("q50", f"QUANTILE_CONT({c}, 0.5)"),
                                     ("q75", f"QUANTILE_CONT({c}, 0.75)"), ("distinct", f"COUNT(DISTINCT {c})"))])


@query("q06_state_bounds", _BOUNDS_SQL)
def q06_state_bounds(spark, sf):
    """Quartiles and distinct counts of both sides by the exact path, and whether those of the states keep their bounds: the
    share of rows below the sketch's quartile, and up to it, enclose the quartile's share within the rank error."""
    rows, names = lineitem_sides(spark, sf), list(P.QNAMES)
    got = run_table(S.profile_of(_by_side(_states(spark, sf, LI_NUMERIC, [])), ["side"]))
    exact = P.column_profile(rows, LI_NUMERIC, [], by=["side"])
    guess = got.select("side", "feature", *[F.col(q).alias(f"s_{q}") for q in names])
    ranks = (P.melt(rows, LI_NUMERIC, ["side"]).where("value IS NOT NULL").join(guess, ["side", "feature"]).groupBy("side", "feature")
             .agg(*[F.avg((F.col("value") < F.col(f"s_{q}")).cast("double")).alias(f"below_{q}") for q in names],
                  *[F.avg((F.col("value") <= F.col(f"s_{q}")).cast("double")).alias(f"upto_{q}") for q in names]))
    bounds = got.select("side", "feature", F.col("distinct").alias("s_distinct"), "distinct_error", "rank_error")
    all_ = exact.join(ranks, ["side", "feature"]).join(bounds, ["side", "feature"])
    within = {q: (F.col(f"below_{q}") - SURE * F.col("rank_error") <= p) & (F.col(f"upto_{q}") + SURE * F.col("rank_error") >= p)
              for q, p in zip(names, P.QUARTILES)}
    within["distinct"] = F.abs(F.col("s_distinct") - F.col("distinct")) <= FAR * F.col("distinct_error")
    return rounded(all_.select("side", "feature", F.inline(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("exact"), ok.alias("within")) for m, ok in within.items()]))))


@query("a12_correlation_from_states", _corr_sql())
def a12_correlation_from_states(spark, sf):
    """A12 from the merge of monthly co-moments."""
    pairs = run_table(S.pair_states(_monthly(li_priced(spark, sf)), LP_NUMERIC, ["month"]))
    return rounded(S.correlations_of(S.merge_pairs(pairs)))


@query("b01_monitor_from_states", REGISTRY_SQL["b01_monitor_run"])
def b01_monitor_from_states(spark, sf):
    """B1 from monthly states of all columns."""
    numeric = [c for c in _LI_COLS if c not in (*LI_CATEGORICAL, "l_shipdate")]
    states = _states(spark, sf, numeric, [*LI_CATEGORICAL, "l_shipdate"])
    return rounded(S.checks_of(_by_side(states), _LI_COLS, LI_NUMERIC))
