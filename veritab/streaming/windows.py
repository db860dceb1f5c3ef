"""Windowed checks over event streams.

The same functions run on a streaming or a batch DataFrame: they are built from the
batch metric expressions, grouped by a tumbling ``window``. Event time is cast to
``timestamp`` (``withWatermark`` rejects ``timestamp_ntz``). Sinks are file sinks or
``foreachBatch`` writers with their checkpoint in the shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab import thresholds as T
from veritab.functions.scalar import col_of, quality_band
from veritab.operators import evaluate as EV
from veritab.operators import rules as R
from veritab.operators.score import score_linear
from veritab.session import checkpoint_dir


# ---------------- sources and runs ----------------
def file_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """A file stream over ``path`` (a folder, a glob, or one file turned into a glob);
    the schema is read once from the same path."""
    schema = spark.read.format(fmt).load(path).schema
    src = path if (path.endswith("/") or "*" in path or "[" in path) else f"{path[:-1]}[{path[-1]}]"
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(src)


def _tz(df: DataFrame) -> str:
    return df.sparkSession.conf.get("spark.sql.session.timeZone")


def event_time(df: DataFrame, ts: str, out: str = "event_ts") -> DataFrame:
    """Event time as ``timestamp`` (watermarks need it). A ``timestamp_ntz`` wall time is
    read as UTC, so tumbling windows fall on its own calendar days whatever the session
    time zone is (the window renderer below undoes the shift)."""
    from pyspark.sql.types import TimestampNTZType
    c = col_of(ts).cast("timestamp")
    if isinstance(df.schema[ts].dataType, TimestampNTZType):
        c = F.from_utc_timestamp(c, _tz(df))
    return df.withColumn(out, c)


def stream_folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


def run_available_now(stream: DataFrame, name: str, mode: str = "append", fmt: str = "parquet") -> DataFrame:
    """Process everything available, then stop; return the sink as a batch frame.
    ``append``: a file sink (each watermark-closed window written once).
    ``complete``: ``foreachBatch`` overwrites the sink with the full result."""
    spark = stream.sparkSession
    out = stream_folder(spark, name)
    w = stream.writeStream.option("checkpointLocation", f"{out}_checkpoint").trigger(availableNow=True)
    if mode == "complete":
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").format(fmt).save(out)
        q = w.outputMode("complete").foreachBatch(write).start()
    else:
        q = w.outputMode("append").format(fmt).option("path", out).start()
    q.awaitTermination()
    return spark.read.format(fmt).load(out)


def _window_cols(tz: str, win: str = "window") -> list[Column]:
    """Window bounds as UTC wall-clock text (the calendar of the event times)."""
    return [F.date_format(F.to_utc_timestamp(F.col(f"{win}.start"), tz), "yyyy-MM-dd HH:mm:ss").alias("window_start"),
            F.date_format(F.to_utc_timestamp(F.col(f"{win}.end"), tz), "yyyy-MM-dd HH:mm:ss").alias("window_end")]


# ---------------- T1 quality ----------------
def window_quality(df: DataFrame, ts: str, duration: str = "1 day", watermark: str = "1 day",
                   columns: Sequence[str] | None = None, value: str | None = None) -> DataFrame:
    """Per tumbling window rows, missing share of all cells in percent, score
    ``max(0, 100 - missing%)`` and band; optional mean and std of a value column."""
    cols = list(columns or [c for c in df.columns if c != ts])
    x = event_time(df, ts).withWatermark("event_ts", watermark)
    nulls = sum((F.when(col_of(c).isNull(), 1).otherwise(0) for c in cols), F.lit(0))
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.sum(nulls).alias("missing_cells")]
    if value:
        aggs += [F.avg(col_of(value)).alias("mean_value"), F.stddev_samp(col_of(value)).alias("std_value")]
    g = x.groupBy(F.window("event_ts", duration)).agg(*aggs)
    pct = F.col("missing_cells") * 100.0 / (F.col("n_rows") * len(cols))
    score = F.greatest(F.lit(0.0), F.lit(100.0) - pct)
    extra = ["mean_value", "std_value"] if value else []
    return g.select(*_window_cols(_tz(df)), "n_rows", pct.alias("missing_percentage"), score.alias("quality_score"),
                    quality_band(score).alias("status"), *extra)


# ---------------- T2 CV drift against a static reference ----------------
def reference_cv(reference: DataFrame, feature: str, by: Sequence[str] = ()) -> DataFrame:
    """Static reference: count, mean, sample std and cv per group (batch aggregate)."""
    x = col_of(feature)
    return reference.groupBy(*by).agg(F.count(x).alias("ref_n"),
                                      F.try_divide(F.stddev_samp(x), F.avg(x)).alias("ref_cv"))


def window_cv_drift(df: DataFrame, reference: DataFrame, ts: str, feature: str, by: Sequence[str] = (),
                    duration: str = "7 days", watermark: str = "7 days") -> DataFrame:
    """Per window and group, cv of the feature against the static reference cv:
    ``min(1, |cv - ref_cv| / max(ref_cv, 0.001))`` (0 with fewer than 2 values). The
    windowed aggregate is joined to the static table (stream-static join)."""
    x = event_time(df, ts).withWatermark("event_ts", watermark)
    v = col_of(feature)
    g = x.groupBy(F.window("event_ts", duration), *[col_of(b) for b in by]).agg(
        F.count(v).alias("n"), F.try_divide(F.stddev_samp(v), F.avg(v)).alias("cv"))
    ref = reference_cv(reference, feature, by)
    if by:
        j = g.join(ref, list(by), "inner")  # one row per caller's group: no hint, its size is not known here
    else:  # one reference row: joined on a constant key, broadcast
        j = g.withColumn("_k", F.lit(0)).join(F.broadcast(ref.withColumn("_k", F.lit(0))), "_k").drop("_k")
    raw = F.abs(F.col("cv") - F.col("ref_cv")) / F.greatest(F.col("ref_cv"), F.lit(T.CV_DIVISOR_FLOOR))
    score = F.when((F.col("n") > 1) & (F.col("ref_n") > 1), F.least(F.lit(1.0), F.coalesce(raw, F.lit(0.0)))) \
        .otherwise(F.lit(0.0))
    return j.select(*_window_cols(_tz(df)), *by, "n", "cv", "ref_cv", score.alias("drift_score"))


# ---------------- T3 windowed performance ----------------
def window_performance(df: DataFrame, ts: str, label: str, pred: str, duration: str = "1 day",
                       watermark: str = "1 day") -> DataFrame:
    """Per window confusion cells and accuracy, precision, recall, F1."""
    x = event_time(df, ts).withWatermark("event_ts", watermark)
    g = x.groupBy(F.window("event_ts", duration)).agg(*EV._cells(label, pred))
    return g.select(*_window_cols(_tz(df)), "tp", "fp", "fn", "tn", *EV.metric_columns())


# ---------------- T4 streaming scoring ----------------
def score_stream(df: DataFrame, weights: Mapping[str, float], bias: float, features: Sequence[str],
                 ts: str | None = None) -> DataFrame:
    """T4: score each arriving row with the linear scorer; log-line shape of S9."""
    s = score_linear(df, weights, bias)
    fmap = F.create_map(*[x for c in features for x in (F.lit(c), col_of(c).cast("double"))])
    return s.select((col_of(ts).cast("timestamp") if ts else F.current_timestamp()).alias("timestamp"),
                    fmap.alias("features"), "prediction", "probability", "prediction_label", "confidence")


# ---------------- T5 alert stream ----------------
def performance_alerts(windowed: DataFrame, rules: DataFrame) -> DataFrame:
    """T5 rule step: windowed metrics to long rows, rules joined, fired rows kept."""
    long = windowed.select("window_start", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in EV.METRICS])))
    return R.apply_rules(long.withColumnRenamed("window_start", "scope"), rules)


def run_alert_stream(windowed_stream: DataFrame, rules: DataFrame, name: str = "alerts") -> DataFrame:
    """T5: windows finalized by the watermark (append mode) go through the rules in
    ``foreachBatch``; only fired alerts are kept, partitioned by type and date. Each batch
    overwrites the folder of its own id, so a replayed batch writes its alerts once."""
    spark = windowed_stream.sparkSession
    out = stream_folder(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        fired = performance_alerts(batch, rules).withColumn("type", F.lit("performance")) \
            .withColumn("date", F.substring("scope", 1, 10))
        fired.write.mode("overwrite").partitionBy("type", "date").parquet(f"{out}/batch={batch_id}")

    q = (windowed_stream.writeStream.option("checkpointLocation", f"{out}_checkpoint").outputMode("append")
         .trigger(availableNow=True).foreachBatch(write).start())
    q.awaitTermination()
    schema = "rule string, scope string, metric string, value double, `limit` double, message string, type string, date string"
    try:
        return spark.read.schema(schema).parquet(out).drop("batch")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # no batch ran, so no folder was made
            raise
        return spark.createDataFrame([], schema)
