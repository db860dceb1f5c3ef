"""Drift between a reference and a current table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab import thresholds as T
from veritab.functions.scalar import col_of, drift_band
from veritab.operators.report import AggCheck, row, rows_from, run_agg_checks


def cv_drift_check(features: Sequence[str], side_col: str = "side",
                   abs_mean: bool = False) -> AggCheck:
    """``min(1, |cv_cur - cv_ref| / max(cv_ref, 0.001))`` per feature, 0 when a side has
    fewer than 2 values; average over features and band. ``cv`` = sample std / mean.
    ``abs_mean=True`` divides by ``|mean|`` (the literal rule collapses negative means)."""
    aggs = []
    for i, f in enumerate(features):
        for s in ("reference", "current"):
            x = F.when(F.col(side_col) == s, col_of(f).cast("double"))
            aggs += [F.count(x).alias(f"_d4_n_{s}_{i}"), F.avg(x).alias(f"_d4_m_{s}_{i}"),
                     F.stddev_samp(x).alias(f"_d4_sd_{s}_{i}")]

    def cv(s, i):
        m = F.col(f"_d4_m_{s}_{i}")
        return F.try_divide(F.col(f"_d4_sd_{s}_{i}"), F.abs(m) if abs_mean else m)

    def finish() -> list:
        structs, scores = [], []
        for i, f in enumerate(features):
            ok = (F.col(f"_d4_n_reference_{i}") > 1) & (F.col(f"_d4_n_current_{i}") > 1)
            ref_cv, cur_cv = cv("reference", i), cv("current", i)
            raw = F.abs(cur_cv - ref_cv) / F.greatest(ref_cv, F.lit(T.CV_DIVISOR_FLOOR))
            score = F.when(ok, F.least(F.lit(T.CV_DRIFT_CAP), F.coalesce(raw, F.lit(0.0)))) \
                .otherwise(F.lit(0.0))
            scores.append(score)
            structs += [row("drift", "reference", f, "cv", ref_cv),
                        row("drift", "current", f, "cv", cur_cv),
                        row("drift", "both", f, "drift_score", score)]
        avg = sum(scores[1:], scores[0]) / F.lit(float(len(scores)))
        structs += [row("drift", "both", None, "average_drift", avg, drift_band(avg)),
                    row("drift", "both", None, "threshold", T.PSI_THRESHOLD)]
        return structs

    return AggCheck("drift", aggs, finish)


def cv_drift(df: DataFrame, features: Sequence[str], side_col: str = "side",
             abs_mean: bool = False) -> DataFrame:
    """D4 on a side-tagged table."""
    return run_agg_checks(df, [cv_drift_check(features, side_col, abs_mean)])


# ---------------------------------------------------------------------------
# Distribution tests and distances
# ---------------------------------------------------------------------------
from pyspark.sql import Window  # noqa: E402

from veritab.functions.scalar import chi2_sf, clamp01, ks_pvalue  # noqa: E402
from veritab.operators.cumulative import exact_quantiles, running_sums  # noqa: E402
from veritab.operators.profile import melt  # noqa: E402

REF, CUR = "reference", "current"


def _side_sums(side_col: str):
    return {"nr": F.when(F.col(side_col) == REF, 1).otherwise(0),
            "nc": F.when(F.col(side_col) == CUR, 1).otherwise(0)}


def ecdf_frame(tagged: DataFrame, features: Sequence[str], side_col: str = "side") -> DataFrame:
    """Both sides' empirical CDFs at every distinct value of every feature, plus the next
    distinct value: the shared input of KS and Wasserstein (distributed running sums)."""
    long = melt(tagged, features, by=[side_col]).where(F.col("value").isNotNull())
    rs = running_sums(long, "value", _side_sums(side_col), by=["feature"], next_value=True)
    return rs.select("feature", "value", "next_value", "nr", "nc", "cum_nr", "tot_nr", "tot_nc",
                     F.try_divide(F.col("cum_nr"), F.col("tot_nr")).alias("f_ref"),
                     F.try_divide(F.col("cum_nc"), F.col("tot_nc")).alias("f_cur"))


def ks_wasserstein(tagged: DataFrame, features: Sequence[str], side_col: str = "side",
                   alpha: float = T.STATISTICAL_TEST_THRESHOLD, ecdf: DataFrame | None = None) -> DataFrame:
    """D1 + D3 (W1) per numeric feature: KS statistic ``max |F_r - F_c|``, asymptotic
    p-value, drift flag ``p < alpha``; Wasserstein-1 ``sum |F_r - F_c| * gap`` and the
    same divided by the reference population std (from the per-value reference counts)."""
    e = ecdf if ecdf is not None else ecdf_frame(tagged, features, side_col)
    gap = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    diff = F.abs(F.col("f_ref") - F.col("f_cur"))
    g = e.groupBy("feature").agg(F.max("tot_nr").alias("n_reference"), F.max("tot_nc").alias("n_current"),
                                 F.max(diff).alias("statistic"), F.sum(diff * gap).alias("wasserstein"))
    # reference population std, two passes over the collapsed (value, count) rows
    mean = e.groupBy("feature").agg(F.try_divide(F.sum(F.col("value") * F.col("nr")), F.sum("nr")).alias("_m"))
    sd = e.join(F.broadcast(mean), "feature").groupBy("feature").agg(
        F.sqrt(F.try_divide(F.sum(F.col("nr") * (F.col("value") - F.col("_m")) ** 2), F.sum("nr"))).alias("_sd"))
    out = g.join(F.broadcast(sd), "feature", "left")
    p = ks_pvalue("statistic", "n_reference", "n_current")
    return out.select("feature", "n_reference", "n_current", "statistic", p.alias("p_value"),
                      (p < alpha).alias("drifted"), "wasserstein",
                      F.when(F.col("_sd") > 0, F.col("wasserstein") / F.col("_sd")).alias("wasserstein_normed"))


def ks_two_sample(tagged: DataFrame, features: Sequence[str], side_col: str = "side",
                  alpha: float = T.STATISTICAL_TEST_THRESHOLD) -> DataFrame:
    """Two-sample KS per numeric feature."""
    return ks_wasserstein(tagged, features, side_col, alpha).select(
        "feature", "n_reference", "n_current", "statistic", "p_value", "drifted")


def chi_square(tagged: DataFrame, features: Sequence[str], side_col: str = "side",
               alpha: float = T.STATISTICAL_TEST_THRESHOLD) -> DataFrame:
    """Pearson chi-square of independence on the K x 2 (value x side) table per
    categorical feature; dof = K - 1; drift when ``p < alpha``. Also the total variation
    distance of the two value distributions as a bounded drift score."""
    long = melt(tagged, features, by=[side_col], cast="string").where(F.col("value").isNotNull())
    cells = long.groupBy("feature", "value").agg(
        F.count_if(F.col(side_col) == REF).alias("o_r"), F.count_if(F.col(side_col) == CUR).alias("o_c"))
    tot = cells.groupBy("feature").agg(F.sum("o_r").alias("n_r"), F.sum("o_c").alias("n_c"),
                                       F.count(F.lit(1)).alias("k"))
    j = cells.join(F.broadcast(tot), "feature")
    n = F.col("n_r") + F.col("n_c")
    row_t = F.col("o_r") + F.col("o_c")
    e_r, e_c = row_t * F.col("n_r") / n, row_t * F.col("n_c") / n
    term = (F.when(e_r > 0, (F.col("o_r") - e_r) ** 2 / e_r).otherwise(0.0)
            + F.when(e_c > 0, (F.col("o_c") - e_c) ** 2 / e_c).otherwise(0.0))
    tv = F.abs(F.try_divide(F.col("o_r"), F.col("n_r")) - F.try_divide(F.col("o_c"), F.col("n_c")))
    g = j.groupBy("feature").agg(F.max("n_r").alias("n_reference"), F.max("n_c").alias("n_current"),
                                 (F.max("k") - 1).alias("dof"), F.sum(term).alias("statistic"),
                                 (F.sum(tv) / 2).alias("tv_distance"))
    p = chi2_sf("statistic", "dof")
    return g.select("feature", "n_reference", "n_current", "dof", "statistic", p.alias("p_value"),
                    (p < alpha).alias("drifted"), "tv_distance")


EPS = 1e-4
DECILES = tuple(i / 10 for i in range(1, 10))
DECILE_NAMES = tuple(f"e{i}" for i in range(1, 10))


def psi_kl(tagged: DataFrame, features: Sequence[str], side_col: str = "side",
           eps: float = EPS, ecdf: DataFrame | None = None) -> DataFrame:
    """D3: PSI and KL(reference || current) on reference-decile bins. Bin = number of
    decile edges strictly below the value (10 bins); shares floored at ``eps``;
    ``PSI = sum (c - r) ln(c / r)``, ``KL = sum r ln(r / c)``. Deciles and bin counts are
    read from the per-value side counts of the ECDF frame (no second scan)."""
    e = ecdf if ecdf is not None else ecdf_frame(tagged, features, side_col)
    below = F.col("cum_nr") - F.col("nr")
    aggs = [F.max("tot_nr").alias("_n")]
    for name, p in zip(DECILE_NAMES, DECILES):
        pos = (F.col("tot_nr") - 1) * F.lit(float(p))
        for tag, r in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            aggs.append(F.max(F.when((below <= r) & (r < F.col("cum_nr")), F.col("value"))).alias(f"_{tag}_{name}"))
    picks = e.groupBy("feature").agg(*aggs)
    cols = ["feature"]
    for name, p in zip(DECILE_NAMES, DECILES):
        pos = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        cols.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    edges = picks.select(*cols)
    j = e.join(F.broadcast(edges), "feature")
    b = sum((F.when(F.col("value") > F.col(x), 1).otherwise(0) for x in DECILE_NAMES), F.lit(0))
    cnt = j.groupBy("feature", b.alias("bin")).agg(F.sum("nr").alias("c_r"), F.sum("nc").alias("c_c"))
    grid = edges.select("feature", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("bin"))
    full = grid.join(cnt, ["feature", "bin"], "left").fillna(0, subset=["c_r", "c_c"])
    w = Window.partitionBy("feature")
    r = F.greatest(F.try_divide(F.col("c_r"), F.sum("c_r").over(w)), F.lit(eps))
    c = F.greatest(F.try_divide(F.col("c_c"), F.sum("c_c").over(w)), F.lit(eps))
    shares = full.select("feature", r.alias("r"), c.alias("c"))
    return shares.groupBy("feature").agg(
        F.sum((F.col("c") - F.col("r")) * F.log(F.col("c") / F.col("r"))).alias("psi"),
        F.sum(F.col("r") * F.log(F.col("r") / F.col("c"))).alias("kl_divergence"))


def distances(tagged: DataFrame, features: Sequence[str], side_col: str = "side",
              th: T.Thresholds = T.DEFAULT) -> DataFrame:
    """D3: PSI, KL, Wasserstein-1 (raw and normed) with their configured limits' flags."""
    e = ecdf_frame(tagged, features, side_col)
    kw = ks_wasserstein(tagged, features, side_col, ecdf=e).select("feature", "wasserstein", "wasserstein_normed")
    pk = psi_kl(tagged, features, side_col, ecdf=e)
    out = pk.join(kw, "feature", "inner")
    return out.select("feature", "psi", "kl_divergence", "wasserstein", "wasserstein_normed",
                      (F.col("psi") > th.psi).alias("psi_drift"),
                      (F.col("kl_divergence") > th.kl_divergence).alias("kl_drift"),
                      (F.col("wasserstein_normed") > th.wasserstein).alias("wasserstein_drift"))


def cv_score(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Single-table score ``min(1, 10 * cv)`` (0 with fewer than 2 values) and band."""
    one = df.agg(*[e for i, f in enumerate(features) for e in (
        F.count(col_of(f)).alias(f"_n{i}"), F.avg(col_of(f)).alias(f"_m{i}"),
        F.stddev_samp(col_of(f)).alias(f"_s{i}"))])
    structs = []
    for i, f in enumerate(features):
        cv = F.try_divide(F.col(f"_s{i}"), F.col(f"_m{i}"))
        score = F.when(F.col(f"_n{i}") > 1, F.least(F.lit(1.0), cv * T.CV_SCORE_FACTOR)).otherwise(0.0)
        structs.append(F.struct(F.lit(f).alias("feature"), cv.alias("cv"), score.alias("drift_score"),
                                drift_band(score).alias("status")))
    return one.select(F.inline(F.array(*structs)))


def column_drift(tagged: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 side_col: str = "side") -> DataFrame:
    """Per-column drift rows ``(feature, test, statistic, p_value, drift_score, drifted)``:
    KS for numeric (score = KS statistic), chi-square for categorical (score = total
    variation distance). Both scores lie in [0, 1]; high means more drift."""
    parts = []
    if numeric:
        parts.append(ks_two_sample(tagged, numeric, side_col).select(
            "feature", F.lit("ks").alias("test"), "statistic", "p_value",
            F.col("statistic").alias("drift_score"), "drifted"))
    if categorical:
        parts.append(chi_square(tagged, categorical, side_col).select(
            "feature", F.lit("chi_square").alias("test"), "statistic", "p_value",
            F.col("tv_distance").alias("drift_score"), "drifted"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dataset_drift(columns: DataFrame, share_limit: float = T.DATASET_DRIFT_SHARE) -> DataFrame:
    """Number and share of drifted columns; dataset drift when the share is over the limit."""
    return columns.agg(F.count(F.lit(1)).alias("n_columns"), F.count_if("drifted").alias("n_drifted")) \
        .withColumn("drift_share", F.try_divide(F.col("n_drifted"), F.col("n_columns"))) \
        .withColumn("dataset_drift", F.col("drift_share") > share_limit)


def drift_metrics_long(columns: DataFrame, summary: DataFrame, n_features: int | None = None) -> DataFrame:
    """D7 input: drift metrics as ``(scope, metric, value)`` rows, each named for what it is."""
    def r(metric, value):
        return F.struct(F.lit(None).cast("string").alias("scope"), F.lit(metric).alias("metric"),
                        value.cast("double").alias("value"))
    share = F.col("n_drifted") / F.lit(n_features) if n_features else F.col("drift_share")
    s = summary.select(F.inline(F.array(r("dataset_drift", F.col("dataset_drift")),
                                        r("drift_share", F.col("drift_share")),
                                        r("drifted_feature_share", share))))
    c = columns.where("drifted").select(F.col("feature").alias("scope"),
                                        F.lit("column_drift_score").alias("metric"),
                                        F.col("drift_score").cast("double").alias("value"))
    return s.unionByName(c)


def drift_causes(columns: DataFrame, limit: float = T.DRIFT_CAUSE_SCORE) -> DataFrame:
    """Drifted columns with score over ``limit`` and the mean score of drifted columns."""
    d = columns.where("drifted")
    mean = d.agg(F.avg("drift_score")).scalar()
    return d.where(F.col("drift_score") > limit).select(
        "feature", "drift_score", mean.alias("mean_drifted_score"))


def target_prediction_drift(tagged: DataFrame, target: str | None, score: str | None,
                            side_col: str = "side") -> DataFrame:
    """Target drift (chi-square on the label) and prediction drift (KS on the score)."""
    parts = []
    if target:
        parts.append(chi_square(tagged, [target], side_col).select(
            F.lit("target_drift").alias("kind"), "feature", "statistic", "p_value", "drifted"))
    if score:
        parts.append(ks_two_sample(tagged, [score], side_col).select(
            F.lit("prediction_drift").alias("kind"), "feature", "statistic", "p_value", "drifted"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
