"""Run log (X1) and run queries (X2): params, metrics and tags per run as map columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RUN_SCHEMA = ("model_name string, version int, params map<string,string>, "
              "metrics map<string,double>, tags map<string,string>")


def run_records(metrics_long: DataFrame, model_col: str, version_col: str,
                params: Mapping[str, str] | None = None, tags: Mapping[str, str] | None = None) -> DataFrame:
    """One record per (model, version) from long metric rows ``(model, version, metric,
    value)``. A run has a handful of metrics, so gathering them into a map is bounded."""
    def lit_map(m):
        m = m or {}
        return F.create_map(*[F.lit(x) for kv in sorted(m.items()) for x in kv]) if m else \
            F.create_map().cast("map<string,string>")
    g = metrics_long.groupBy(F.col(model_col).alias("model_name"), F.col(version_col).cast("int").alias("version")) \
        .agg(F.map_from_entries(F.collect_list(F.struct(F.col("metric"), F.col("value").cast("double"))))
             .alias("metrics"))
    return g.select("model_name", "version", lit_map(params).alias("params"), "metrics", lit_map(tags).alias("tags"))


def append_runs(runs: DataFrame, path: str) -> None:
    """Append to the run log (parquet, partitioned by model)."""
    runs.write.mode("append").partitionBy("model_name").parquet(path)


def metrics_of(runs: DataFrame) -> DataFrame:
    """Run metrics back to long rows."""
    return runs.select("model_name", "version", F.explode("metrics").alias("metric", "value"))


def best_run(runs: DataFrame, metric: str) -> DataFrame:
    """The run with the highest ``metric``; ties to the lower version, then model name."""
    key = F.struct(F.col("metrics")[metric], -F.col("version"), F.col("model_name"))
    return runs.agg(F.max_by(F.struct("model_name", "version", F.col("metrics")[metric].alias(metric)), key)
                    .alias("b")).select("b.*")


def latest_versions(runs: DataFrame) -> DataFrame:
    """Latest version per model (``max_by`` per model: partial aggregation, no window)."""
    return runs.groupBy("model_name").agg(F.max("version").alias("version"),
                                          F.max_by("metrics", "version").alias("metrics"))


def list_runs(runs: DataFrame) -> DataFrame:
    """Every run by model, the latest version first."""
    return runs.select("model_name", "version").orderBy("model_name", F.desc("version"))
