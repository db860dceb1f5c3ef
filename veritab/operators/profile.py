"""Profiles and descriptive statistics.

Every statistic of many columns is one aggregate over one scan (or over a melted
``(feature, value)`` view of it). Quantiles are exact and distributed
(:func:`veritab.operators.cumulative.exact_quantiles`); no group is ever gathered
into a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from veritab import thresholds as T
from veritab.functions.scalar import col_of
from veritab.operators.comoments import correlations
from veritab.operators.cumulative import exact_quantiles
from veritab.session import run_table, spread

#: Columns whose pairs (276) are still one row of aggregates.
NARROW = 23


def join_small(big: DataFrame, small: DataFrame, on: Sequence[str]) -> DataFrame:
    """Equi-join with a table of one row per group; adaptive execution broadcasts it where its
    measured size allows. With no keys the small side is a single row, joined on a constant key."""
    on = list(on)
    if on:
        return big.join(small, on=on, how="inner")
    return (big.withColumn("_g", F.lit(0))
            .join(F.broadcast(small.withColumn("_g", F.lit(0))), on="_g", how="inner").drop("_g"))


def numeric_names(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]


def melt(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), cast: str = "double",
         var: str = "feature", val: str = "value") -> DataFrame:
    """Wide to long ``(by..., feature, value)`` by ``unpivot`` (a generator). Only the needed
    columns are kept; a single-partition input is spread first (see ``session.spread``)."""
    src = spread(df.select(*[col_of(b) for b in by], *[col_of(c).cast(cast).alias(c) for c in cols]))
    return src.unpivot(list(by), list(cols), var, val)


def shape(df: DataFrame) -> DataFrame:
    """A1: row and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """A2: rows per class (partial + final hash aggregate)."""
    return df.groupBy(col_of(target).alias(target)).agg(F.count(F.lit(1)).alias("n"))


def class_shares(df: DataFrame, target: str) -> DataFrame:
    """A3: class counts and percent of all rows (the total is a scalar subquery)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return class_counts(df, target).withColumn("percent", F.col("n") * 100.0 / total)


def missing_values(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A4: per column missing count and percent, plus a ``__total__`` row (one aggregate)."""
    cols = list(cols or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(col_of(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("missing"))
               for i, c in enumerate(cols)]
    total = sum((F.col(f"_m{i}") for i in range(1, len(cols))), F.col("_m0"))
    structs.append(F.struct(F.lit("__total__").alias("column_name"), total.alias("missing")))
    long = one.select("_n", F.inline(F.array(*structs)))
    denom = F.when(F.col("column_name") == "__total__", F.col("_n") * len(cols)).otherwise(F.col("_n"))
    return long.select("column_name", "missing",
                       F.when(denom > 0, F.col("missing") * 100.0 / denom).alias("percent"))


QUARTILES = (0.25, 0.5, 0.75)
QNAMES = ("q25", "q50", "q75")


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample std, min, exact linear quartiles, max per column (and group)."""
    long = melt(df, cols, by)
    keys = [*by, "feature"]
    basic = long.groupBy(*keys).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    qs = exact_quantiles(long, "value", QUARTILES, keys, QNAMES).drop("n")
    return (basic.join(qs, on=keys, how="left")
            .select(*keys, "count", "mean", "std", "min", *QNAMES, "max"))


def iqr_fences(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
               factor: float = T.IQR_FACTOR) -> DataFrame:
    """Q1, Q3, IQR and the fences ``Q1 - f*IQR``, ``Q3 + f*IQR``."""
    long = melt(df, cols, by)
    q = exact_quantiles(long, "value", (0.25, 0.75), [*by, "feature"], ("q1", "q3")).drop("n")
    iqr = F.col("q3") - F.col("q1")
    return q.select(*by, "feature", "q1", "q3", iqr.alias("iqr"),
                    (F.col("q1") - factor * iqr).alias("lower"), (F.col("q3") + factor * iqr).alias("upper"))


def _flag_outliers(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    long = melt(df, cols, by)
    fences = iqr_fences(df, cols, by)
    # fences: one row per (group, feature); without groups they are broadcast, so that no task gets all
    # rows of a feature, else adaptive execution broadcasts them if they are small
    j = long.join(fences if by else F.broadcast(fences), on=[*by, "feature"], how="inner")
    return j.withColumn("is_outlier", (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper")))


def outlier_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per feature, rows, outliers outside the IQR fences and their percent."""
    f = _flag_outliers(df, cols)
    return f.groupBy("feature").agg(F.count(F.lit(1)).alias("n"),
                                    F.count_if("is_outlier").alias("outliers")) \
        .withColumn("percent", F.col("outliers") * 100.0 / F.col("n"))


def outlier_cells(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Outlier cells over all numeric columns and share ``cells / (rows * cols) * 100``."""
    f = _flag_outliers(df, cols)
    return f.agg(F.count_if("is_outlier").alias("outlier_cells"),
                 (F.count(F.lit(1)) / len(cols)).cast("long").alias("n_rows")) \
        .withColumn("n_columns", F.lit(len(cols))) \
        .withColumn("percent", F.try_divide(F.col("outlier_cells") * 100.0, F.col("n_rows") * F.col("n_columns")))


def row_hashes(cols: Sequence[str]) -> list:
    """Two independent 64-bit hashes of a row. A null is told from any value by its own flag."""
    cs = [col_of(c) for c in cols]
    flags = [c.isNull() for c in cs]
    return [F.xxhash64(*cs, *flags).alias("_h1"), F.xxhash64(F.lit("second"), *flags, *reversed(cs)).alias("_h2")]


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A10: copies after the first, and their percent. Rows are compared by a 128-bit hash of
    all columns, so 24 bytes per distinct row are shuffled whatever the width of the table; a hot
    group of copies is merged map-side by the partial aggregate."""
    cols = list(cols or df.columns)
    g = df.groupBy(*row_hashes(cols)).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("duplicates")) \
        .withColumn("percent", F.try_divide(F.col("duplicates") * 100.0, F.col("n_rows")))


def drop_duplicates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per full-row (or ``cols``) value."""
    return df.dropDuplicates(list(cols) if cols else None)


def _correlation(a: Column, b: Column) -> Column:
    """Pearson correlation over the rows that have both; null where one of them does not vary
    (``corr`` divides by zero there)."""
    a, b = a.cast("double"), b.cast("double")
    spread_of = lambda x, other: F.stddev_pop(F.when(other.isNotNull(), x))
    return F.try_divide(F.covar_pop(a, b), spread_of(a, b) * spread_of(b, a))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix, pairwise complete, as long rows ``(feature_a, feature_b, corr)``. Few columns are one
    row of aggregates; more than ``NARROW`` go through blocks of co-moments (:mod:`comoments`), also in one scan."""
    cols = list(cols)
    if len(cols) > NARROW:
        return correlations(df, cols)
    df = spread(df.select(*[col_of(c) for c in cols]))
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    aggs = [_correlation(col_of(cols[i]), col_of(cols[j])).alias(f"_c{i}_{j}") for i, j in pairs]
    aggs += [F.stddev_pop(col_of(c).cast("double")).alias(f"_s{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    structs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                v = F.when(F.col(f"_s{i}") > 0, F.lit(1.0))
            else:
                v = F.col(f"_c{min(i, j)}_{max(i, j)}")
            structs.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                                    v.cast("double").alias("corr")))
    return one.select(F.inline(F.array(*structs)))


def target_correlation(df: DataFrame, cols: Sequence[str], target: Column, k: int = 10) -> DataFrame:
    """Correlation of every feature with a 0/1 target, descending, top ``k``."""
    one = df.agg(*[_correlation(col_of(c), target).alias(f"_t{i}") for i, c in enumerate(cols)])
    long = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"),
                                                  F.col(f"_t{i}").alias("corr"))
                                         for i, c in enumerate(cols)])))
    return long.orderBy(F.desc_nulls_last("corr"), "feature").limit(k)


def strong_pairs(corr_long: DataFrame, cols: Sequence[str],
                 limit: float = T.CORRELATION_LIMIT) -> DataFrame:
    """Upper-triangle pairs with ``|r| > limit``."""
    order = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    return corr_long.where((order[F.col("feature_a")] < order[F.col("feature_b")])
                           & (F.abs("corr") > limit))


def histogram(df: DataFrame, col: str, by: Sequence[str] = (), bins: int = 20) -> DataFrame:
    """Equal-width bins between the group's min and max, last bin closed, empty bins kept."""
    x = col_of(col).cast("double")
    rng = df.groupBy(*by).agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    grid = rng.select(*by, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    grid = grid.select(*by, "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                       F.when(F.col("bin") == bins - 1, F.col("hi"))
                       .otherwise(F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"))
    binned = join_small(df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull()), rng, by)
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("lo")) / width), F.lit(bins - 1))).cast("int")
    counts = binned.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, on=[*by, "bin"], how="left").fillna(0, subset=["n"])


def box_stats(df: DataFrame, col: str, by: Sequence[str] = (), factor: float = T.IQR_FACTOR) -> DataFrame:
    """Quartiles, whiskers (last datum inside the fences) and flier count per group."""
    long = melt(df, [col], by)
    q = exact_quantiles(long, "value", QUARTILES, [*by, "feature"], ("q1", "median", "q3")).drop("n")
    j = long.join(q, on=[*by, "feature"], how="inner")
    iqr = F.col("q3") - F.col("q1")
    inside = F.col("value").between(F.col("q1") - factor * iqr, F.col("q3") + factor * iqr)
    inner = F.when(inside, F.col("value"))
    agg = j.groupBy(*by).agg(F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
                             F.min(inner).alias("whisker_low"), F.max(inner).alias("whisker_high"),
                             F.count_if(~inside).alias("fliers"))
    return agg.select(*by, "q1", "median", "q3", "whisker_low", "whisker_high", "fliers")


def score_summary(df: DataFrame, col: str) -> DataFrame:
    """Mean, max and min of a score column."""
    x = col_of(col)
    return df.agg(F.avg(x).alias("mean"), F.max(x).alias("max"), F.min(x).alias("min"))


def argmax_row(df: DataFrame, col: str, tiebreak: Sequence[str]) -> DataFrame:
    """The row at the maximum of ``col``; ties go to the smallest ``tiebreak`` key.
    Top-1 per partition, then one merge (TakeOrderedAndProject)."""
    return df.orderBy(F.desc(col), *[F.asc(t) for t in tiebreak]).limit(1)


def coefficient_of_variation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sample std / mean per column (one aggregate)."""
    one = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.avg(col_of(c)).alias(f"_m{i}"), F.stddev_samp(col_of(c)).alias(f"_s{i}"))])
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("feature"), F.col(f"_m{i}").alias("mean"), F.col(f"_s{i}").alias("std"),
        F.try_divide(F.col(f"_s{i}"), F.col(f"_m{i}")).alias("cv")) for i, c in enumerate(cols)])))


def error_feature_stats(df: DataFrame, label: str, pred: str, cols: Sequence[str], k: int = 5) -> DataFrame:
    """Mean and sample std of each feature over misclassified rows; top ``k`` by std."""
    err = df.where(col_of(label) != col_of(pred))
    one = err.agg(*[e for i, c in enumerate(cols) for e in (
        F.avg(col_of(c)).alias(f"_m{i}"), F.stddev_samp(col_of(c)).alias(f"_s{i}"))])
    long = one.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("feature"), F.col(f"_m{i}").alias("mean"), F.col(f"_s{i}").alias("std"))
        for i, c in enumerate(cols)])))
    return long.orderBy(F.desc_nulls_last("std"), "feature").limit(k)


def dataset_profile(df: DataFrame) -> DataFrame:
    """Rows, total, numeric and string column counts."""
    fields = df.schema.fields
    n_num = sum(isinstance(f.dataType, NumericType) for f in fields)
    n_str = sum(isinstance(f.dataType, StringType) for f in fields)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(fields)).alias("n_columns"), F.lit(n_num).alias("n_numeric"),
        F.lit(n_str).alias("n_string"))


def sample_counts(df: DataFrame, target: str) -> DataFrame:
    """Negative, positive and total rows of a 0/1 target."""
    t = col_of(target)
    return df.agg(F.count_if(t == 0).alias("negative"), F.count_if(t == 1).alias("positive"),
                  F.count(F.lit(1)).alias("total"))


def sort_desc(df: DataFrame, col: str, key: str) -> DataFrame:
    """Descending sort (nulls last) with a stable key, with the rank made explicit. Rows are dealt out by range and
    written once when the frame is built; each range ranks its own rows after those of the ranges before it, so no task
    holds more than a range. Rows that agree in value and key are ranked in any order. A column ``rank`` is replaced."""
    order = [F.desc_nulls_last(col_of(col)), F.asc(col_of(key))]
    part, ahead = "_range", "_ahead"
    dealt = run_table(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = dealt.groupBy(part).agg(F.count(F.lit(1)).alias("_n")).select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(ahead))
    within = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return dealt.join(starts, part).withColumn("rank", within + F.col(ahead)).drop(part, ahead).orderBy("rank")


def top_k(df: DataFrame, col: str, k: int, tiebreak: Sequence[str]) -> DataFrame:
    """Top-k rows (partial top-k per partition, one merge)."""
    return df.orderBy(F.desc(col), *[F.asc(t) for t in tiebreak]).limit(k)


def normalise_by_max(df: DataFrame, col: str, out: str = "normalised") -> DataFrame:
    """``x / max(x)``; the maximum is a scalar subquery, so rows are not moved."""
    mx = df.agg(F.max(col_of(col))).scalar()
    return df.withColumn(out, F.try_divide(col_of(col), mx))


def value_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), cast: str = "string") -> DataFrame:
    """Distinct values with counts per (group, feature): the shared step of distinct counts
    and modes; partial aggregation absorbs hot values."""
    long = melt(df, cols, by, cast=cast)
    return long.groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def column_profile(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                   by: Sequence[str] = ()) -> DataFrame:
    """Q6: per (group, column): count, missing, distinct, most common value (ties to the
    smallest), and for numeric columns mean, std, min, quartiles, max."""
    keys = [*by, "feature"]
    # missing counts of every column: one grouped aggregate, unpivoted (no melt)
    allc = [*numeric, *categorical]
    m1 = df.groupBy(*[col_of(b) for b in by]).agg(
        *[F.count_if(col_of(c).isNull()).alias(c) for c in allc])
    miss = m1.unpivot(list(by), allc, "feature", "missing")
    parts = []
    if numeric:
        vc = value_counts(df, numeric, by, cast="double").where(F.col("value").isNotNull())
        modes = vc.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("distinct"),
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode_num"))
        d = describe(df, numeric, by)
        parts.append(d.join(miss, keys, "left").join(modes, keys, "left")
                     .withColumn("mode_text", F.lit(None).cast("string")))
    if categorical:
        vc = value_counts(df, categorical, by).where(F.col("value").isNotNull())
        modes = vc.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("distinct"), F.sum("n").alias("count"),
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode_text"))
        c = miss.where(F.col("feature").isin(list(categorical))).join(modes, keys, "left")
        for name in ("mean", "std", "min", *QNAMES, "max", "mode_num"):
            c = c.withColumn(name, F.lit(None).cast("double"))
        parts.append(c)
    cols = [*keys, "count", "missing", "distinct", "mode_text", "mode_num", "mean", "std", "min",
            *QNAMES, "max"]
    out = parts[0].select(*cols)
    for p in parts[1:]:
        out = out.unionByName(p.select(*cols))
    return out.fillna(0, subset=["count", "distinct"])
