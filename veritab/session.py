"""Session helpers.

Cluster settings (shuffle partitions, executor sizes, checkpoint folder) belong to the
cluster; this module only fills in values that are unset, which is what tests need.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "veritab") -> SparkSession:
    """Return the active session, or build a local one with safe defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    Read from ``spark.checkpoint.dir`` (set by the cluster, on shared storage). Only when
    it is unset, as in local tests, a scratch folder is made and set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.startswith("local"):
            configured = tempfile.mkdtemp(prefix="veritab-ckpt-")
        else:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_WRITTEN: list[tuple[SparkSession, str]] = []


def run_table(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in a folder of this run below the shared checkpoint folder, and
    read back: cuts lineage, survives executor loss, prunes columns. :func:`drop_run_tables` removes
    the tables of the run; it is also called when the driver ends."""
    spark = df.sparkSession
    if not _WRITTEN:
        atexit.register(drop_run_tables)
    path = f"{checkpoint_dir(spark)}/run-table-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_run_tables() -> None:
    """Delete the tables that :func:`run_table` has written; frames that read them are void then."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        sc = spark.sparkContext
        if sc._jsc is None or sc._jsc.sc().isStopped():
            continue  # the folder belongs to a run that has ended
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def file_bytes(df: DataFrame) -> int:
    """Size of the files that the plan of ``df`` reads, as their listing gives it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    return sum(int(str(x.stats().sizeInBytes())) for x in found if x.getClass().getSimpleName() == "LogicalRelation")


#: Bytes of files behind the rows that one task of :func:`spread` gets.
SPREAD_BYTES = 16 << 20


def spread(df: DataFrame, *by: Column) -> DataFrame:
    """Spread row-expanding work (melts, bootstrap replicates, per-row hashing) of a table that
    lies in few files over all cores: one row group scans as one task. The number of tasks follows the size of
    the files, so what one task holds does not grow with them. Files and sizes are known when the plan is made, so no
    job is started; a table of many files is left as it is, without a shuffle. Results do not depend on it. Rows are dealt
    out in turn, which sorts them first, or by the hash of ``by``, which does not."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) * 2 <= target:
        return df.repartition(max(target, -(-file_bytes(df) // SPREAD_BYTES)), *by)
    return df
