"""Scoring (G1-G4, F7, F8): fitted-model batch scoring, the linear scorer as SQL
expressions, feature-record batches and the prediction-log profile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.functions.scalar import col_of, confidence_band, label_text


def linear_score(weights: Mapping[str, float], bias: float) -> Column:
    """``1 / (1 + exp(-(b + sum w*x)))`` as one codegen expression."""
    z = sum((col_of(c).cast("double") * float(w) for c, w in weights.items()), F.lit(float(bias)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def score_linear(df: DataFrame, weights: Mapping[str, float], bias: float, threshold: float = 0.5) -> DataFrame:
    """Probability, class at ``>= threshold``, confidence band and label text; all of them null
    where an input is null."""
    p = linear_score(weights, bias)
    return (df.withColumn("probability", p)
            .withColumn("prediction", (F.col("probability") >= threshold).cast("int"))
            .withColumn("confidence", confidence_band("probability"))
            .withColumn("prediction_label", label_text("prediction")))


def score_records(records: DataFrame, record_col: str, weights: Mapping[str, float], bias: float,
                  id_col: str | None = None, threshold: float = 0.5, keep: Sequence[str] = ()) -> DataFrame:
    """Score feature records (``map<string,double>``); each record gives a result or an
    error naming what is missing or null (all other fields are null then). Per-record position comes from ``id_col`` when
    given (e.g. ``posexplode`` of a request array); ``keep``: further columns to carry."""
    m = F.col(record_col)
    names = list(weights)
    wanted = F.array(*[F.lit(n) for n in names])
    missing = F.filter(wanted, lambda k: ~F.map_contains_key(m, k))
    empty = F.filter(wanted, lambda k: F.map_contains_key(m, k) & F.element_at(m, k).isNull())
    error = (F.when(m.isNull(), F.lit("record is null"))
             .when(F.size(missing) > 0, F.concat(F.lit("missing features: "), F.array_join(missing, ", ")))
             .when(F.size(empty) > 0, F.concat(F.lit("null features: "), F.array_join(empty, ", "))))
    z = sum((m[n] * float(w) for n, w in weights.items()), F.lit(float(bias)))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    ok = error.isNull()
    out = records.select(
        *[col_of(c) for c in keep],
        *([F.col(id_col).alias("id")] if id_col else []),
        F.when(ok, (p >= threshold).cast("int")).alias("prediction"),
        F.when(ok, p).alias("probability"),
        F.when(ok, confidence_band(p)).alias("confidence"),
        F.when(ok, label_text((p >= threshold).cast("int"))).alias("prediction_label"),
        F.when(ok, F.array_sort(F.map_keys(m))).alias("features_used"),
        error.alias("error"))
    return out


def explode_batch(batch: DataFrame, array_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per record of a request array, with its position as id. An empty or null array has none."""
    return batch.select(*[col_of(c) for c in keep], F.posexplode(F.col(array_col)).alias("id", "record"))


def score_batch(batch: DataFrame, array_col: str, request: str, weights: Mapping[str, float], bias: float,
                threshold: float = 0.5) -> DataFrame:
    """Every record of every request's array scored at its position; bad records carry their error and
    do not fail the others."""
    return score_records(explode_batch(batch, array_col, [request]), "record", weights, bias, "id", threshold, [request])


def batch_summary(batch: DataFrame, array_col: str, request: str, scored: DataFrame) -> DataFrame:
    """Records, good and bad ones per request; zeros for an empty or null array."""
    good = scored.groupBy(col_of(request)).agg(F.count_if(F.col("error").isNull()).alias("successful"), F.count("error").alias("failed"))
    total = F.greatest(F.size(F.col(array_col)), F.lit(0)).cast("long")
    return (batch.select(col_of(request), total.alias("total")).join(good, request, "left")
            .select(request, "total", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("successful", "failed")]))


def prediction_log(df: DataFrame, features: Sequence[str], prob_col: str = "probability",
                   pred_col: str = "prediction") -> DataFrame:
    """Log rows ``timestamp, features map, prediction, probability, label``."""
    fmap = F.create_map(*[x for c in features for x in (F.lit(c), col_of(c).cast("double"))])
    return df.select(F.current_timestamp().alias("timestamp"), fmap.alias("features"),
                     col_of(pred_col).cast("int").alias("prediction"),
                     col_of(prob_col).cast("double").alias("probability"),
                     label_text(pred_col).alias("prediction_label"))


def log_profile(log: DataFrame, prob_col: str = "probability", pred_col: str = "prediction") -> DataFrame:
    """Count, mean probability and positive share per confidence band."""
    return log.groupBy(confidence_band(prob_col).alias("confidence")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(col_of(prob_col)).alias("mean_probability"),
        F.avg(col_of(pred_col).cast("double")).alias("positive_share"))
