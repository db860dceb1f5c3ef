"""Row-wise scalar functions (F1-F15), as Spark ``Column`` expressions.

All of them stay inside whole-stage codegen except the higher-order array helpers,
which still run in the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritab import thresholds as T

__all__ = [
    "col_of", "row_mean", "row_std", "row_max", "safe_ratio", "clamp01", "floor_at",
    "band", "quality_band", "drift_band", "confidence_band", "label_text", "binary_target",
    "fmt_fixed", "fmt_percent", "map_keys_of", "relative_change", "direction_word",
    "uniform_hash", "hash_order_key", "nan_to_null", "ks_pvalue", "erfc", "chi2_sf",
]


def col_of(c) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def _present(cols: Sequence) -> list[Column]:
    return [col_of(c).cast("double") for c in cols]


def row_mean(cols: Sequence) -> Column:
    """mean over k columns, nulls skipped (pandas ``mean(axis=1)``)."""
    cs = _present(cols)
    s = sum((F.coalesce(c, F.lit(0.0)) for c in cs), F.lit(0.0))
    n = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in cs), F.lit(0))
    return F.when(n > 0, s / n)


def row_std(cols: Sequence) -> Column:
    """sample std (n-1) over k columns, nulls skipped; null when fewer than 2 values."""
    cs = _present(cols)
    n = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in cs), F.lit(0))
    m = row_mean(cols)
    ss = sum((F.coalesce((c - m) * (c - m), F.lit(0.0)) for c in cs), F.lit(0.0))
    return F.when(n > 1, F.sqrt(ss / (n - 1)))


def row_max(cols: Sequence) -> Column:
    """row-wise max; ``greatest`` skips nulls."""
    return F.greatest(*_present(cols))


def safe_ratio(num, den) -> Column:
    """ratio, null where the divisor is 0 or null (pandas would give +-inf)."""
    return F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))


def clamp01(c) -> Column:
    """``min(1, x)`` as used by the capped drift score."""
    return F.least(F.lit(1.0), col_of(c))


def floor_at(c, lo: float) -> Column:
    """``max(lo, x)``."""
    return F.greatest(F.lit(float(lo)), col_of(c))


def band(c, cuts, otherwise: str, ascending: bool) -> Column:
    """band a value. ``ascending=False``: first cut with value >= cut wins;
    ``ascending=True``: first cut with value < cut wins. A null value has no band."""
    x = col_of(c)
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    for cut, name in cuts:
        expr = expr.when((x < cut) if ascending else (x >= cut), name)
    return expr.otherwise(otherwise)


def quality_band(c) -> Column:
    return band(c, T.QUALITY_BANDS, T.QUALITY_BAND_ELSE, ascending=False)


def drift_band(c) -> Column:
    return band(c, T.DRIFT_BANDS, T.DRIFT_BAND_ELSE, ascending=True)


def confidence_band(c) -> Column:
    """confidence words of a probability."""
    return band(c, T.CONFIDENCE_BANDS, T.CONFIDENCE_BAND_ELSE, ascending=False)


def label_text(c) -> Column:
    """F8: text of a 0/1 prediction; a null prediction has none."""
    x = col_of(c)
    return F.when(x == 1, T.LABEL_POSITIVE).when(x.isNotNull(), T.LABEL_NEGATIVE)


def binary_target(c, positive) -> Column:
    """1 where the column equals the positive value, else 0."""
    return (col_of(c) == F.lit(positive)).cast("int")


def fmt_fixed(c, digits: int = 2) -> Column:
    """``{x:.2f}``: half-even rounding of the exact binary value, as Python formats
    (``format_number`` uses it; its grouping commas are removed)."""
    return F.regexp_replace(F.format_number(col_of(c), digits), ",", "")


def fmt_percent(c, digits: int = 2) -> Column:
    """``{x:.2%}``."""
    return F.concat(fmt_fixed(col_of(c) * 100, digits), F.lit("%"))


def map_keys_of(c) -> Column:
    """keys of a feature record."""
    return F.map_keys(col_of(c))


def relative_change(cur, ref) -> Column:
    """``(cur - ref) / ref``, only where ref > 0."""
    r = col_of(ref)
    return F.when(r > 0, (col_of(cur) - r) / r)


def direction_word(c) -> Column:
    return F.when(col_of(c) > 0, "increase").when(col_of(c) < 0, "decrease").otherwise("unchanged")


def uniform_hash(*keys, seed: int | str = 42) -> Column:
    """Reproducible uniform number in [0, 1) from integer keys and a seed.

    ``conv(substr(md5(k1|...|seed), 1, 8), 16, 10) / 2^32``; DuckDB twin:
    ``('0x' || substr(md5(k1||'|'||...||'|'||seed), 1, 8))::bigint / 2^32``.
    """
    h = F.md5(F.concat_ws("|", *[col_of(k).cast("string") for k in keys], F.lit(str(seed))))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / float(2 ** 32)


def hash_order_key(*keys, seed: int | str = 42) -> Column:
    """Full md5 hex string of keys and seed: a total, engine-independent row order."""
    return F.md5(F.concat_ws("|", *[col_of(k).cast("string") for k in keys], F.lit(str(seed))))


def nan_to_null(c) -> Column:
    x = col_of(c)
    return F.when(~F.isnan(x), x)


def ks_pvalue(d, n, m, terms: int = 100) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value (Smirnov 1948), with
    ``lambda = D * sqrt(n*m/(n+m))``: for ``lambda < 1.18`` the theta-function form
    ``1 - sqrt(2*pi)/lambda * sum exp(-(2k-1)^2 pi^2 / (8 lambda^2))``, else the
    alternating series ``2 * sum (-1)^(k-1) exp(-2 k^2 lambda^2)``; clamped to [0, 1]."""
    d, n, m = col_of(d).cast("double"), col_of(n).cast("double"), col_of(m).cast("double")
    lam = d * F.sqrt(n * m / (n + m))
    small = F.lit(1.0) - F.sqrt(F.lit(2 * 3.141592653589793)) / lam * F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.exp(-((2 * k - 1) * (2 * k - 1)) * F.lit(3.141592653589793 ** 2) / (8 * lam * lam)))
    large = F.lit(2.0) * F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam))
    p = F.when(lam.isNull(), None).when(lam <= 0, 1.0).when(lam < 1.18, small).otherwise(large)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), p))


def erfc(x) -> Column:
    """Complementary error function of ``x >= 0``: below 1.5 by the series of erf (40 terms
    reach double precision there), else by the continued fraction of 60 levels."""
    x = col_of(x).cast("double")
    z = x * x
    term = F.aggregate(F.sequence(F.lit(1), F.lit(40)), F.struct(x.alias("t"), x.alias("s")),
                       lambda acc, n: F.struct((acc["t"] * 2 * z / (2 * n + 1)).alias("t"),
                                               (acc["s"] + acc["t"] * 2 * z / (2 * n + 1)).alias("s")))
    small = F.lit(1.0) - F.lit(2 / math.sqrt(math.pi)) * F.exp(-z) * term["s"]
    # erfc(x) = exp(-x^2) / sqrt(pi) / (x + (1/2)/(x + (2/2)/(x + (3/2)/(x + ...))))
    tail = F.aggregate(F.sequence(F.lit(60), F.lit(1), F.lit(-1)), x, lambda acc, n: x + n / F.lit(2.0) / acc)
    return F.when(x < 1.5, small).otherwise(F.exp(-z) / F.lit(math.sqrt(math.pi)) / tail)


#: Degrees of freedom up to which the finite sum is used; beyond, the expansion errs by less than 1e-9.
CHI2_SUM_DOF = 2000


def chi2_sf(stat, dof) -> Column:
    """Chi-square survival function ``Q(a, y)`` with ``a = dof / 2``, ``y = stat / 2``.

    Up to ``CHI2_SUM_DOF`` degrees by the finite sum over all of its ``a`` terms (for odd degrees
    ``erfc(sqrt(y))`` first), which is exact and keeps small p-values. Beyond, by Temme's
    uniform expansion in ``1 / a`` with two terms, whose error falls as ``a^-2.5``."""
    x, k = col_of(stat).cast("double"), col_of(dof).cast("long")
    a, y = k / F.lit(2.0), x / 2
    odd = k % 2 == 1
    # terms exp(-y) y^j / Gamma(j + 1), j = 0, 1, ... (even) or 1/2, 3/2, ... (odd), as logarithms
    first = F.when(odd, F.lit(0.5) * F.log(y) - F.lit(math.log(math.sqrt(math.pi) / 2))).otherwise(0.0) - y
    shift = F.when(odd, 0.5).otherwise(0.0)
    start = F.struct(first.alias("t"), F.exp(first).alias("s"))
    total = F.aggregate(F.when(a > shift + 1, F.sequence(F.lit(1), F.ceil(a - shift).cast("int") - 1)).otherwise(F.array()), start,
                        lambda acc, n: F.struct((acc["t"] + F.log(y) - F.log(n + shift)).alias("t"),
                                                (acc["s"] + F.exp(acc["t"] + F.log(y) - F.log(n + shift))).alias("s")))["s"]
    total = F.when(odd, erfc(F.sqrt(y)) + F.when(k > 1, total).otherwise(0.0)).otherwise(total)
    # Temme: Q = erfc(eta sqrt(a / 2)) / 2 + exp(-a eta^2 / 2) / sqrt(2 pi a) (C0 + C1 / a)
    mu = y / a - 1
    near = F.abs(mu) < 0.01  # mu - ln(1 + mu) cancels there
    half = F.when(near, mu * mu * (F.lit(0.5) - mu / 3 + mu * mu / 4 - mu ** 3 / 5 + mu ** 4 / 6)).otherwise(mu - F.log(mu + 1))
    eta = F.signum(mu) * F.sqrt(2 * half)
    c0 = F.when(near, F.lit(-1 / 3) + eta / 12 - eta ** 2 * 2 / 135 + eta ** 3 / 864 + eta ** 4 / 2835).otherwise(1 / mu - 1 / eta)
    c1 = F.when(near, F.lit(-1 / 540) - eta / 288 + eta ** 2 / 378).otherwise(
        1 / eta ** 3 - 1 / mu ** 3 - 1 / mu ** 2 - 1 / (12 * mu))
    rest = F.exp(-a * half) / F.sqrt(F.lit(2 * math.pi) * a) * (c0 + c1 / a)
    side = erfc(F.abs(eta) * F.sqrt(a / 2)) / 2
    wide = F.when(eta >= 0, side).otherwise(1 - side) + rest
    out = (F.when(x.isNull() | k.isNull(), None).when(k <= 0, 1.0).when(x <= 0, 1.0)
           .when(k <= CHI2_SUM_DOF, total).otherwise(wide))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), out))
