"""Written tables in the shared checkpoint folder, input helpers and connected components."""

from __future__ import annotations

import atexit
import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.session import checkpoint_dir


class Scratch:
    """Intermediate tables of one run, as Parquet in the folder of ``spark.checkpoint.dir``.

    A written table cuts lineage and survives lost executors. ``drop`` removes tables that no
    later frame reads; the rest goes when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        atexit.register(self.drop, "")

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Lets Spark's cleaner delete the shuffle files behind written tables: it does so when the
        driver has collected the frames that made them."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        sc = self.spark.sparkContext
        if sc._jsc is None or sc._jsc.sc().isStopped():
            return  # the run has ended
        for name in names:
            path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    """Tasks after a shuffle in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def fresh(name: str, columns: list[str]) -> str:
    """``name``, or with underscores after it a name that no column has (letter case does not count)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(scratch: Scratch, links: DataFrame, tag: str) -> DataFrame:
    """(node, root) of every linked node; root is the smallest node reachable.

    ``links``: a, b long. Each round takes the smallest label of all neighbours and then follows
    the labels one step (pointer jumping); every round is a written table. Hubs are aggregated
    (minimum per node), never gathered."""
    both = scratch.save(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct()
                        .toDF("node", "other"), f"{tag}-edges")
    labels = scratch.save(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")),
                          f"{tag}-labels0")
    step, changed = 0, True
    while changed:
        near = (both.join(labels.toDF("other", "seen"), "other")
                .groupBy("node").agg(F.min("seen").alias("seen")))
        better = (labels.join(near, "node")
                  .select("node", F.col("root").alias("old"), F.least("root", "seen").alias("mid")))
        jumped = (better.join(labels.toDF("mid", "far"), "mid", "left")
                  .select("node", "old", F.least("mid", F.coalesce("far", "mid")).alias("root")))
        step += 1
        new = scratch.save(jumped, f"{tag}-labels{step}")
        changed = not new.where("old <> root").isEmpty()
        scratch.drop(f"{tag}-labels{step - 1}")
        labels = new.select("node", "root")
    return labels
