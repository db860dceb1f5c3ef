"""Feature pipeline.

Splits and folds are exact and reproducible across engines: rows are ordered inside each
class by the md5 of their key and a seed. The rank inside a class is computed without
gathering the class in one task: rows go to 4096 buckets by the first three hex digits
of the md5 (uniform), bucket counts per class give offsets (classes x 4096 rows), and
``row_number`` runs per (class, bucket).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.functions.scalar import col_of, hash_order_key, row_max, row_mean, row_std, safe_ratio
from veritab.operators.shape import drop_all_null_columns, drop_name_pattern
from veritab.operators.cumulative import running_sums
from veritab.operators import radix
from veritab.session import spread

#: Rows of an offset table up to which it is broadcast.
MOST_OFFSETS = 100_000


# ---------------- E1 clean ----------------
def clean(df: DataFrame, pattern: str = "Unnamed") -> tuple[DataFrame, DataFrame]:
    """Drop all-null columns (P1), pattern-named columns (P2) and duplicate rows.
    Returns the clean frame and one row of counts (rows/columns before, after, removed)."""
    step1 = drop_all_null_columns(df)
    step2 = drop_name_pattern(step1, pattern)
    out = step2.dropDuplicates()
    removed_cols = len(df.columns) - len(out.columns)
    before = df.agg(F.count(F.lit(1)).alias("rows_before"))
    after = out.agg(F.count(F.lit(1)).alias("rows_after"))
    counts = before.withColumn("_g", F.lit(0)).join(F.broadcast(after.withColumn("_g", F.lit(0))), "_g").drop("_g") \
        .select("rows_before", "rows_after", (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
                F.lit(len(df.columns)).alias("columns_before"), F.lit(len(out.columns)).alias("columns_after"),
                F.lit(removed_cols).alias("columns_removed"))
    return out, counts


# ---------------- E2 derive ----------------
@dataclass(frozen=True)
class Derivation:
    """Row-wise group statistics and ratios, each made only when its inputs exist."""
    groups: Mapping[str, tuple[str, Sequence[str]]] = field(default_factory=dict)  # name -> (stat, cols)
    ratios: Mapping[str, tuple[str, str]] = field(default_factory=dict)           # name -> (num, den)


_ROW_STATS = {"mean": row_mean, "std": row_std, "max": row_max}


def derive(df: DataFrame, spec: Derivation) -> DataFrame:
    """Add derived columns in one projection (``withColumns``)."""
    have = set(df.columns)
    new: dict[str, Column] = {}
    for name, (stat, cols) in spec.groups.items():
        present = [c for c in cols if c in have]
        if present:
            new[name] = _ROW_STATS[stat](present)
    for name, (num, den) in spec.ratios.items():
        if num in have and den in have:
            new[name] = safe_ratio(num, den)
    return df.withColumns(new) if new else df


# ---------------- E3 encode ----------------
def encode_target(df: DataFrame, target: str, out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Label index by alphabetical order of the distinct values (B->0, M->1).
    The order is a distributed running count of the distinct values, so any number of values
    will do; adaptive execution broadcasts the mapping where its measured size allows."""
    out = out or f"{target}_encoded"
    values = df.select(col_of(target).alias("value")).where(F.col("value").isNotNull()).distinct()
    mapping = running_sums(values, "value", {"n": F.lit(1)}).select("value", (F.col("cum_n") - 1).cast("int").alias("index"))
    enc = df.join(mapping.withColumnRenamed("value", target).withColumnRenamed("index", out), on=target, how="left")
    return enc, mapping


# ---------------- E4/E5 ANOVA F selection ----------------
def anova_f(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One-way ANOVA F per feature: ``(sum n_k (m_k - m)^2 / (K-1)) / (sum (n_k-1) s_k^2 / (N-K))``.
    One grouped aggregate per class for all features (classes are few), then a combine."""
    per = df.groupBy(col_of(label).alias("_k")).agg(*[e for i, f in enumerate(features) for e in (
        F.count(col_of(f)).alias(f"n{i}"), F.avg(col_of(f)).alias(f"m{i}"), F.var_samp(col_of(f)).alias(f"v{i}"))])
    # per-class table: one row per class (few); grand means by a window over it
    w = Window.partitionBy()
    per = per.select("*", *[(F.sum(F.col(f"n{i}") * F.col(f"m{i}")).over(w) / F.sum(f"n{i}").over(w))
                            .alias(f"g{i}") for i in range(len(features))])
    aggs = []
    for i in range(len(features)):
        n, m, v, g = F.col(f"n{i}"), F.col(f"m{i}"), F.col(f"v{i}"), F.col(f"g{i}")
        aggs += [F.sum(n).alias(f"N{i}"), F.count_if(n > 0).alias(f"K{i}"),
                 F.sum(F.when(n > 0, n * (m - g) * (m - g))).alias(f"B{i}"),
                 F.sum(F.coalesce((n - 1) * v, F.lit(0.0))).alias(f"W{i}")]
    tot = per.agg(*aggs)
    structs = []
    for i, f in enumerate(features):
        N, K, B, W = (F.col(f"{x}{i}") for x in "NKBW")
        fstat = F.try_divide(F.try_divide(B, K - 1), F.try_divide(W, N - K))
        structs.append(F.struct(F.lit(i).alias("position"), F.lit(f).alias("feature"),
                                fstat.cast("double").alias("f_stat")))
    return tot.select(F.inline(F.array(*structs)))


def select_k_best(df: DataFrame, features: Sequence[str], label: str, k: int,
                  keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """E5: top ``k`` features by F, output in the original column order; ``k = min(k, n)``.
    The ranking is a table of one row per feature, read back to build the projection."""
    scores = anova_f(df, features, label).orderBy(F.desc_nulls_last("f_stat"), "position") \
        .limit(min(k, len(features))).collect()
    chosen = sorted((r["position"], r["feature"]) for r in scores)
    names = [n for _, n in chosen]
    return df.select(*[col_of(c) for c in [*keep, *names]]), names


# ---------------- E6 / M6 exact stratified split and folds ----------------
def _class_rank(df: DataFrame, label: str, key: Sequence[str], seed, copies: int = 1):
    """Rank of each row inside its class in md5(key|seed) order (1-based ``_rank``): rows are ranked within
    buckets of neighbouring keys, whose number follows the number of rows (``copies`` classes of them
    each); offsets are an equi-join on (class, bucket)."""
    h = hash_order_key(*key, seed=seed)
    digits = radix.digits_for(df.count() // max(copies, 1))
    x = spread(df).withColumn("_h", h).withColumn("_b", radix.bucket(F.col("_h"), digits))
    offs = radix.offsets(x.select(col_of(label).alias("_lbl"), "_b"), ["_lbl"]).select("_lbl", F.col("_b").alias("_ob"), "_off")
    if copies > 1 and copies * 16 ** digits <= MOST_OFFSETS:  # a known number of classes and buckets
        offs = F.broadcast(offs)
    j = x.join(offs, (x[label].eqNullSafe(offs["_lbl"])) & (x["_b"] == offs["_ob"]), "inner").drop("_ob", "_lbl")
    w = Window.partitionBy(col_of(label), F.col("_b")).orderBy("_h")
    return j.withColumn("_rank", F.row_number().over(w) + F.col("_off")).drop("_off")


def class_quotas(df: DataFrame, label: str, test_size: float, class_counts: DataFrame | None = None) -> DataFrame:
    """Test rows per class: ``T = ceil(N * test_size)`` shared by largest remainder
    (ties to the smaller class value). Small table: one row per class. ``class_counts``
    (``_lbl, n_k``) may be given to avoid another scan."""
    c = class_counts if class_counts is not None else \
        df.groupBy(col_of(label).alias("_lbl")).agg(F.count(F.lit(1)).alias("n_k"))
    w = Window.partitionBy()
    n = F.sum("n_k").over(w)
    t = F.ceil(n * F.lit(float(test_size)))
    exact = t * F.col("n_k") / n
    c = c.select("_lbl", "n_k", exact.alias("_exact"), F.floor(exact).alias("_base"), t.alias("_t"))
    c = c.withColumn("_left", F.col("_t") - F.sum("_base").over(w))
    c = c.withColumn("_order", F.row_number().over(
        Window.orderBy(F.desc(F.col("_exact") - F.col("_base")), F.asc("_lbl"))))
    return c.select("_lbl", "n_k", (F.col("_base") + F.when(F.col("_order") <= F.col("_left"), 1).otherwise(0))
                    .cast("long").alias("quota"))


def stratified_split(df: DataFrame, label: str, key: Sequence[str], test_size: float = 0.2,
                     seed=42, split_col: str = "split") -> DataFrame:
    """Exact stratified split; ``split`` is ``test`` for the first quota rows of each class in
    md5(key|seed) order, else ``train``. The class limits come from radix selection, so rows are
    neither shuffled nor sorted; rows of equal keys fall together."""
    h = hash_order_key(*key, seed=seed)
    joined, inside = radix.within_quota(df, label, h, class_quotas(df, label, test_size))
    return joined.withColumn(split_col, F.when(inside, "test").otherwise("train")).drop("_limit")


def stratified_folds(df: DataFrame, label: str, key: Sequence[str], k: int = 5, seed=42,
                     fold_col: str = "fold") -> DataFrame:
    """M6: fold = (rank in class - 1) mod k, rank by md5(key|seed): every fold gets each
    class's rows to within one."""
    ranked = _class_rank(df, label, key, seed)
    return ranked.withColumn(fold_col, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")) \
        .drop("_rank", "_h", "_b")


def hash_split(df: DataFrame, key: Sequence[str], test_size: float = 0.2, seed=42,
               split_col: str = "split") -> DataFrame:
    """E6 at scale, no ranking: ``uniform(key|seed) < test_size`` (approximate quotas)."""
    from veritab.functions.scalar import uniform_hash
    return df.withColumn(split_col, F.when(uniform_hash(*key, seed=seed) < test_size, "test").otherwise("train"))


# ---------------- E7 scaling ----------------
def fit_standard(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """E7 fit: mean and population std per feature (one aggregate, one row)."""
    return df.agg(*[e for i, f in enumerate(features) for e in (
        F.avg(col_of(f)).alias(f"_m{i}"), F.stddev_pop(col_of(f)).alias(f"_s{i}"))])


def apply_standard(df: DataFrame, fitted: DataFrame, features: Sequence[str]) -> DataFrame:
    """E7 apply: ``(x - mean) / std``, with std 0 treated as 1. The fitted row is one row:
    read back as literals so scaling stays a map-only projection."""
    r = fitted.first()
    cols = {}
    for i, f in enumerate(features):
        m, s = r[f"_m{i}"], r[f"_s{i}"]
        s = 1.0 if (s is None or s == 0) else s
        cols[f] = (col_of(f) - F.lit(m)) / F.lit(s)
    return df.withColumns(cols)


def standard_scale(train: DataFrame, test: DataFrame, features: Sequence[str]):
    """Fit on train only, apply to both; returns (train, test, fitted)."""
    fitted = fit_standard(train, features)
    return apply_standard(train, fitted, features), apply_standard(test, fitted, features), fitted


# ---------------- M5 class weights ----------------
def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """M5: ``n / (K * n_k)`` per class as a weight column (class table broadcast)."""
    c = df.groupBy(col_of(label).alias("_lbl")).agg(F.count(F.lit(1)).alias("_nk"))
    w = Window.partitionBy()
    c = c.select("_lbl", (F.sum("_nk").over(w) / (F.count(F.lit(1)).over(w) * F.col("_nk"))).alias(out))
    return df.join(F.broadcast(c), df[label].eqNullSafe(c["_lbl"]), "left").drop("_lbl")
