"""Stream result equals the batch result; driver contract smoke checks."""

from pyspark.sql import functions as F

from veritab.streaming import windows as S


def test_window_quality_stream_equals_batch(spark, sf):
    path = f"{sf}/events.parquet"
    batch = S.window_quality(spark.read.parquet(path), "ts", "1 day", "1 day", value="value")
    stream = S.run_available_now(S.window_quality(S.file_stream(spark, path), "ts", "1 day", "1 day", value="value"),
                                 "test_t1", mode="complete")
    cols = ["window_start", "n_rows", "missing_percentage"]
    assert sorted(map(tuple, batch.select(*cols).collect())) == sorted(map(tuple, stream.select(*cols).collect()))


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert {"check", "side", "feature", "metric", "value", "status"} == set(df.columns)


def test_registry_names_have_sql_columns(spark):
    import __spark_entry__ as E
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 141
