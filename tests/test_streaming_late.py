"""Append mode over several micro-batches: closed windows once, late rows dropped, replayed alerts once."""

import datetime as dt

from pyspark.sql import functions as F

from veritab.operators import rules as R
from veritab.streaming import windows as W

SCHEMA = "ts timestamp, value double, label int, prediction int"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def files(spark, tmp_path):
    """Three files in order: days 1-3, day 6, and a late row of day 1 with days 9 and 10."""
    folder = str(tmp_path / "in")
    for rows in ([(at(1, 1), 1.0, 1, 1), (at(1, 2), None, 1, 0), (at(2, 1), 2.0, 0, 0), (at(3, 1), 3.0, 1, 1)],
                 [(at(6, 1), 6.0, 1, 0)],
                 [(at(1, 5), 99.0, 1, 1), (at(9, 1), 9.0, 0, 1), (at(10, 1), 1.0, 1, 1)]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return W.file_stream(spark, folder + "/", max_files=1)


def test_closed_windows_are_appended_once_and_late_rows_are_dropped(spark, tmp_path):
    q = W.window_quality(files(spark, tmp_path), "ts", "1 day", "1 day", columns=["value"], value="value")
    got = sorted((r.window_start[:10], r.n_rows, r.mean_value) for r in W.run_available_now(q, "late").collect())
    # the watermark ends at day 9, 01:00: windows that end later are still open
    assert got == [("2024-01-01", 2, 1.0), ("2024-01-02", 1, 2.0), ("2024-01-03", 1, 3.0), ("2024-01-06", 1, 6.0)]


def test_alerts_of_a_replayed_batch_are_written_once(spark, tmp_path):
    w = W.window_performance(files(spark, tmp_path), "ts", "label", "prediction", "1 day", "1 day")
    rules = R.rule_table(spark, R.PERFORMANCE_RULES[:4])
    alerts = W.run_alert_stream(w, rules, "replay")
    rows = alerts.groupBy("rule", "scope").agg(F.count("*").alias("n")).collect()
    assert rows and all(r.n == 1 for r in rows)
    assert {r.scope[:10] for r in rows} <= {f"2024-01-{d:02d}" for d in (1, 2, 3, 6)}
