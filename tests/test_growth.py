import glob

import numpy as np
from pyspark.sql import functions as F

from veritab import session
from veritab.operators import boosting as B
from veritab.operators import cumulative as C
from veritab.operators import profile as PR
from veritab.plans.preprocess import preprocess
from veritab.sources import io as IO


def test_binned_rows_walk_as_node_by_node():
    r = np.random.default_rng(3)
    x = r.integers(0, 256, (500, 4)).astype(np.uint8)
    tree = B.empty_tree(4)
    tree.feature[:15], tree.bin[:15], tree.missing_left[:15] = r.integers(0, 4, 15), r.integers(0, 255, 15), r.random(15) < 0.5
    tree.feature[[4, 6]] = -1
    tree.bin[0], tree.missing_left[0] = 254, True
    want = []
    for row in x:
        at = 0
        while tree.feature[at] >= 0:
            v = row[tree.feature[at]]
            left = tree.missing_left[at] if v == B.MISSING else v <= tree.bin[at]
            at = 2 * at + (1 if left else 2)
        want.append(at)
    assert np.array_equal(B._binned_leaves(tree, x), want)
    assert np.array_equal(B._binned_leaves(B.empty_tree(3), x), np.zeros(500))


def test_preprocessing_drops_duplicates_once(spark):
    df = spark.range(60).select("id", (F.col("id") % 7).cast("double").alias("u"), (F.col("id") % 5).cast("double").alias("v"),
                                (F.col("id") % 2).cast("string").alias("t"))
    prep = preprocess(df.unionByName(df.limit(10)), "t", ["id"], k_best=2)
    plan = prep.train._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan
    assert prep.train.count() + prep.test.count() == 60


def test_logged_runs_are_compressed(spark, tmp_path):
    log = spark.createDataFrame([(i, "x" * 50) for i in range(20)], "a long, b string")
    IO.append_prediction_log(log, str(tmp_path), "first")
    assert glob.glob(f"{tmp_path}/data/run=first/*.json.gz") and not glob.glob(f"{tmp_path}/data/run=first/*.json")
    assert sorted((r.a, r.b) for r in IO.read_runs(spark, str(tmp_path), log.schema).collect()) == [(i, "x" * 50) for i in range(20)]


def test_tasks_of_a_spread_table_follow_its_files(spark, tmp_path, monkeypatch):
    spark.range(20_000).select((F.col("id") * 7 % 9_973).alias("u")).coalesce(1).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    cores = spark.sparkContext.defaultParallelism
    assert session.spread(df).rdd.getNumPartitions() == cores
    monkeypatch.setattr(session, "SPREAD_BYTES", 1 << 10)
    assert session.spread(df).rdd.getNumPartitions() > 4 * cores
    assert session.spread(df).agg(F.sum("u")).first()[0] == df.agg(F.sum("u")).first()[0]
    assert session.spread(spark.createDataFrame([(1,)], "u int")).rdd.getNumPartitions() == cores


def test_fences_without_groups_move_no_rows(spark):
    df = spark.range(200).select((F.col("id") % 50).cast("double").alias("u"), F.when(F.col("id") == 3, 1e6).otherwise(F.col("id")).alias("v"))
    flags = PR._flag_outliers(df, ["u", "v"])
    assert "strategy=broadcast" in flags._jdf.queryExecution().optimizedPlan().toString()
    assert {r.feature: r.outliers for r in PR.outlier_counts(df, ["u", "v"]).collect()} == {"u": 0, "v": 1}


def test_ranges_of_running_sums_follow_the_files(spark, tmp_path, monkeypatch):
    spark.range(3_000).select((F.col("id") * 7 % 997).cast("double").alias("u"), (F.col("id") % 2).alias("g")).coalesce(1).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    few = {tuple(r) for r in C.running_sums(df, "u", {"n": F.lit(1)}, ["g"], next_value=True).collect()}
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = []
    keep = C.run_table
    monkeypatch.setattr(C, "run_table", lambda x: made.append(keep(x)) or made[-1])
    monkeypatch.setattr(C, "RANGE_BYTES", session.file_bytes(df) // (width + 5))
    sums = C.running_sums(df, "u", {"n": F.lit(1)}, ["g"], next_value=True)
    assert {tuple(r) for r in sums.collect()} == few
    assert made[0].select("_bk").distinct().count() > width
    assert f"{2 * -(-session.file_bytes(df) // C.RANGE_BYTES)}" in sums._jdf.queryExecution().optimizedPlan().toString()
