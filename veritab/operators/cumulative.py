"""Distributed running sums over a value order, and exact quantiles built on them.

A plain ``Window.orderBy(v)`` (no partition) runs in one task; grouping only by a
feature or a label gives one task per group, and a group may hold a third of all rows.
Here rows are collapsed to distinct values per group with map-side partial aggregation, dealt
out by range of (group, value), and written once with the number of their range. Adaptive
execution sets the number of ranges by the size of the data; where the files behind them ask for more than the
session's shuffle has tasks, there is one for every ``RANGE_BYTES``, and the sums are finished in twice as many
tasks. The totals of the ranges (one row per
range and group in it) give each its offset, and the running sum is finished by a window
partitioned by (group, range). No step holds a whole group in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.session import file_bytes, run_table

#: Bytes of files behind the rows of one range.
RANGE_BYTES = 4 << 20


def running_sums(df: DataFrame, value: str, sums: Mapping[str, Column], by: Sequence[str] = (),
                 next_value: bool = False) -> DataFrame:
    """Collapse ``df`` to one row per (by..., value) and add running totals.

    Output columns: ``by..., value``, for each name in ``sums``: ``name`` (sum at this value),
    ``cum_name`` (sum over values <= this one within the group) and ``tot_name`` (group total);
    with ``next_value``: the next larger distinct value of the group (null for the last).

    The collapse is a partial + final aggregate (a hot value is merged map-side). The collapsed
    table is written once (``session.run_table``) when this is called: the number of a row's range
    must not change between the offsets and the rows, which a plan that is run twice
    could not promise.
    """
    by = list(by)
    names = list(sums)
    single = not by
    if single:
        # one global group: a constant key keeps every step below the same
        df = df.withColumn("_g", F.lit(0))
        by = ["_g"]
    collapsed = (df.select(*by, F.col(value).alias(value), *[sums[n].alias(n) for n in names])
                 .groupBy(*by, value)
                 .agg(*[F.sum(n).alias(n) for n in names]))
    ranges = -(-file_bytes(df) // RANGE_BYTES)
    many = ranges > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = collapsed.repartitionByRange(ranges, *by, value) if many else collapsed.repartitionByRange(*by, value)
    collapsed = run_table(dealt.withColumn("_bk", F.spark_partition_id()))

    bucket_aggs = [F.sum(n).alias(f"_bs_{n}") for n in names]
    if next_value:
        bucket_aggs.append(F.min(value).alias("_bmin"))
    totals = collapsed.groupBy(*by, "_bk").agg(*bucket_aggs)
    wb = Window.partitionBy(*by).orderBy("_bk")
    wall = Window.partitionBy(*by)
    cols = [*by, "_bk"]
    for n in names:
        cols.append(F.coalesce(F.sum(f"_bs_{n}").over(
            wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_off_{n}"))
        cols.append(F.sum(f"_bs_{n}").over(wall).alias(f"tot_{n}"))
    if next_value:
        cols.append(F.min("_bmin").over(wb.rowsBetween(1, Window.unboundedFollowing)).alias("_nextb"))
    # one row per range and group in it; adaptive execution broadcasts it if its measured size allows
    offsets = totals.select(*cols)

    if many:
        collapsed = collapsed.repartition(2 * ranges, *by, "_bk")
    joined = collapsed.join(offsets, on=[*by, "_bk"], how="inner")
    w = Window.partitionBy(*by, "_bk").orderBy(value)
    out = [*by, value]
    for n in names:
        out.append(F.col(n))
        out.append((F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, 0))
                    + F.col(f"_off_{n}")).alias(f"cum_{n}"))
        out.append(F.col(f"tot_{n}"))
    if next_value:
        out.append(F.coalesce(F.lead(value).over(w), F.col("_nextb")).alias("next_value"))
    res = joined.select(*out)
    return res.drop("_g") if single else res


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (position ``p*(n-1)``), nulls skipped.

    Equal to Spark ``percentile`` and DuckDB ``quantile_cont``, but computed from
    distributed cumulative counts instead of one buffer of all values per group.
    Output: ``by..., n, <name>...`` (names default to ``q<p*100>``).
    """
    by = list(by)
    names = list(names) if names else [f"q{int(round(p * 100)):02d}" for p in probs]
    rs = running_sums(df.where(F.col(value).isNotNull()), value, {"n": F.lit(1)}, by)
    below = F.col("cum_n") - F.col("n")
    aggs = [F.max("tot_n").alias("n")]
    for name, p in zip(names, probs):
        pos = (F.col("tot_n") - 1) * F.lit(float(p))
        for tag, r in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            aggs.append(F.max(F.when((below <= r) & (r < F.col("cum_n")), F.col(value)))
                        .alias(f"_{tag}_{name}"))
    g = rs.groupBy(*by).agg(*aggs)
    outs = [*by, "n"]
    for name, p in zip(names, probs):
        pos = (F.col("n") - 1) * F.lit(float(p))
        frac = pos - F.floor(pos)
        lo, hi = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        outs.append((lo + (hi - lo) * frac).alias(name))
    return g.select(*outs)
