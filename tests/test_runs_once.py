import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veritab.sources import io as IO

SCHEMA = StructType().add("type", "string").add("ts", "timestamp").add("rule", "string")


def _alerts(spark, n):
    return spark.range(n).select(F.when(F.col("id") % 2 == 0, "quality").otherwise("drift").alias("type"),
                                 F.lit("2024-01-02 03:04:05").cast("timestamp").alias("ts"), F.col("id").cast("string").alias("rule"))


def _rules(spark, path):
    return sorted((r.run_id, r.rule) for r in IO.read_runs(spark, path, SCHEMA).collect())


def test_repeated_run_writes_once(spark, tmp_path):
    path = str(tmp_path / "alerts")
    assert _rules(spark, path) == []
    for run in ("007", "007", "2024-01-02"):
        IO.write_alerts(_alerts(spark, 3), path, run)
    assert _rules(spark, path) == [(r, str(i)) for r in ("007", "2024-01-02") for i in range(3)]
    back = IO.read_runs(spark, path, SCHEMA)
    assert sorted({r.type for r in back.collect()}) == ["drift", "quality"]


def test_killed_run_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "log")
    IO.append_run(_alerts(spark, 2), path, "a")

    @F.udf("string")
    def dies(v):
        if v == "3":
            raise RuntimeError("executor lost")
        return v

    with pytest.raises(Exception, match="executor lost"):
        IO.append_run(_alerts(spark, 4).repartition(4).withColumn("rule", dies("rule")), path, "b")
    # killed between its data and its commit: whole data, but not ended
    _alerts(spark, 4).withColumn("run_id", F.lit("b")).write.mode("overwrite").json(f"{path}/data/run=b")
    assert _rules(spark, path) == [("a", "0"), ("a", "1")]
    assert IO.append_run(_alerts(spark, 4), path, "b") and not IO.append_run(_alerts(spark, 4), path, "b")
    assert _rules(spark, path) == [("a", "0"), ("a", "1"), *[("b", str(i)) for i in range(4)]]


def test_empty_run_and_names(spark, tmp_path):
    path = str(tmp_path / "empty")
    IO.write_alerts(_alerts(spark, 0), path, "none")
    assert _rules(spark, path) == [] and IO.committed_runs(spark, path).count() == 1
    with pytest.raises(ValueError):
        IO.append_run(_alerts(spark, 1), path, "../x")
