"""Sources and sinks.

Reads go through :func:`clean_nan` once, so NaN in floating columns becomes null and
every aggregate skips it (the pandas rule). Writes are plain DataFrame writers; nothing
is copied through the driver or a machine-local folder.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

__all__ = [
    "clean_nan", "read_table", "read_csv", "load_table", "load_pair", "resolve_path",
    "read_if_exists", "read_feature_list", "write_table", "write_metadata", "write_report_csv",
    "write_report_json", "append_prediction_log", "write_alerts", "save_model", "load_model",
    "report_json", "append_run", "committed_runs", "read_runs",
]


def clean_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every float/double column (one projection, stays in codegen)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.when(~F.isnan(c), c).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | None = None, nan_to_null: bool = True, **options) -> DataFrame:
    """Scan a table; explicit schema when given, inference only as fallback."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return clean_nan(df) if nan_to_null else df


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with header; types from ``schema`` or inferred."""
    opts = {"header": "true"}
    if schema is None:
        opts["inferSchema"] = "true"
    return read_table(spark, path, "csv", schema=schema, **opts)


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables, NaN cleaned."""
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_pair(spark: SparkSession, train_path: str, test_path: str, target: str,
              fmt: str = "parquet") -> tuple[DataFrame, DataFrame, list[str]]:
    """train/test pair plus the feature list (all columns but the target).
    The target stays in the frame: Spark rows keep label and features together."""
    train = read_table(spark, train_path, fmt)
    test = read_table(spark, test_path, fmt)
    features = [c for c in train.columns if c != target]
    return train, test, features


def resolve_path(path: str, bucket: str | None = None, environment: str | None = None,
                 scheme: str = "gs") -> str:
    """S3: object-store URI when the environment is ``cloud``, the plain path otherwise."""
    env = environment or os.environ.get("ENVIRONMENT", "local")
    if env == "cloud" and bucket:
        return f"{scheme}://{bucket}/{path.lstrip('/')}"
    return path


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame | None:
    """S3: a missing path gives ``None`` instead of an error."""
    try:
        return read_table(spark, path, fmt, **options)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def read_feature_list(spark: SparkSession, path: str, field: str = "feature_names") -> list[str]:
    """Feature list from a metadata JSON document (bounded: one short array)."""
    meta = spark.read.option("multiLine", "true").json(path)
    row = meta.select(F.col(field)).first()
    return list(row[0]) if row and row[0] is not None else []


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Write a processed table."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_metadata(spark: SparkSession, meta: Mapping, path: str) -> None:
    """One-row metadata document."""
    spark.createDataFrame([(json.dumps(meta, sort_keys=True, default=str),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """Report table as CSV with header."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def report_json(df: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Nest a long report into JSON text, one document per group."""
    body = F.to_json(F.collect_list(F.struct(*[c for c in df.columns if c not in group_by])))
    if group_by:
        return df.groupBy(*group_by).agg(body.alias("value"))
    return df.agg(body.alias("value"))


def write_report_json(df: DataFrame, path: str) -> None:
    """One JSON object per row."""
    df.write.mode("overwrite").json(path)


def append_run(df: DataFrame, path: str, run_id: str, partition_by: Sequence[str] = ()) -> bool:
    """Append the rows of one run as JSON lines (gzip), once: a run that is repeated after it has ended writes nothing
    (False), one that was killed is written anew.

    Data go to ``path/data/run=<id>`` first (overwritten by each attempt), then the run's one-row file
    ``path/commits/run=<id>`` says that they are whole. :func:`read_runs` takes the runs that have one. Attempts of
    the same run must not write at the same time. ``run_id``: letters, digits, ``.``, ``_`` and ``-``."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", run_id):
        raise ValueError(f"run id {run_id!r}")
    spark, path = df.sparkSession, path.rstrip("/")
    if committed_runs(spark, path).where(F.col("run_id") == run_id).count():
        return False
    w = df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("compression", "gzip")
    (w.partitionBy(*partition_by) if partition_by else w).json(f"{path}/data/run={run_id}")
    spark.createDataFrame([(run_id,)], "run_id string").coalesce(1).write.mode("overwrite").json(f"{path}/commits/run={run_id}")
    return True


def committed_runs(spark: SparkSession, path: str) -> DataFrame:
    """run_id of every run that :func:`append_run` has finished."""
    return _json_or_empty(spark, f"{path.rstrip('/')}/commits", StructType().add("run_id", "string")).distinct()


def read_runs(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of all finished runs with their ``run_id``; rows of a run that has not ended are left out."""
    rows = _json_or_empty(spark, f"{path.rstrip('/')}/data", StructType([*schema.fields, StructField("run_id", StringType())]))
    return rows.join(committed_runs(spark, path), "run_id", "left_semi")


def _json_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON rows below ``path`` (none where it does not exist yet)."""
    try:
        return spark.read.schema(schema).json(path).select(*schema.fieldNames())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_prediction_log(df: DataFrame, path: str, run_id: str | None = None) -> None:
    """Append scored rows as JSON lines (``timestamp, features, prediction, probability,
    prediction_label``); with a ``run_id`` a repeated run writes once (:func:`append_run`)."""
    if run_id is None:
        df.write.mode("append").json(path)
    else:
        append_run(df, path, run_id)


def write_alerts(alerts: DataFrame, path: str, run_id: str | None = None) -> None:
    """Partitioned append by alert type and date; an empty frame adds no partition. With a ``run_id``
    a repeated run writes once (:func:`append_run`)."""
    dated = alerts.withColumn("date", F.date_format(F.col("ts"), "yyyyMMdd"))
    if run_id is None:
        dated.write.mode("append").partitionBy("type", "date").json(path)
    else:
        append_run(dated, path, run_id, ["type", "date"])


def save_model(model, path: str) -> None:
    """Spark ML persistence in place of pickles."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """Load a saved ``PipelineModel``."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
