"""Exact quotas per class without ranking rows (E6): radix selection over the rows' hash order.

The rows of a class that belong to its quota are those with the smallest md5 keys, so one number per
class decides all of them: the key at the quota's rank. It is found digit by digit. Each round scans
the class and key columns only, counts the next ``DIGITS`` hexadecimal digits of the keys that begin with
their class's known prefix (added up before the shuffle: at most 16^DIGITS rows per class and task leave it),
and extends the prefix by the digits at which the running count reaches what is left of the quota. A class
ends when the count is met exactly; keys of different rows differ, so a few rounds do. The split is then a
comparison of every row with its class's limit, without a sort or a window over rows.

Rows with equal keys have equal hashes and fall together; where a quota would part them, all of them are
in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.functions.scalar import col_of
from veritab.session import run_table

#: Hexadecimal digits counted per round, and digits of a key.
DIGITS, WIDTH = 3, 32


def limits(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """_lbl, limit: the largest key of the quota of each class, as a prefix filled up with ``~`` (after every
    digit); null for a quota of 0.

    ``rows``: _lbl, _h (hexadecimal key). ``quotas``: _lbl, quota."""
    state = run_table(quotas.select("_lbl", F.col("quota").cast("long").alias("left"), F.lit("").alias("prefix"), (F.col("quota") <= 0).alias("done")))
    for at in range(0, WIDTH, DIGITS):
        open_ = state.where("not done")
        if open_.isEmpty():
            break
        held = open_.select(F.col("_lbl").alias("_of"), "prefix", "left")
        counts = (rows.join(held, rows["_lbl"].eqNullSafe(held["_of"]))
                  .where(F.col("_h").startswith(F.col("prefix")))
                  .groupBy("_of", F.substring("_h", at + 1, DIGITS).alias("digits")).agg(F.count(F.lit(1)).alias("n"), F.max("left").alias("left")))
        up = Window.partitionBy("_of").orderBy("digits")  # over at most 16^DIGITS counts of a class
        reach = counts.select("_of", "digits", "n", "left", F.sum("n").over(up).alias("upto"))
        # the first digits at which the quota is reached; a quota beyond the class takes its last digits
        hit = F.min(F.when(F.col("upto") >= F.col("left"), F.struct("digits", "upto", "n")))
        found = (reach.groupBy("_of").agg(F.coalesce(hit, F.max(F.struct("digits", "upto", "n"))).alias("x"), F.max("left").alias("was"))
                 .select("_of", F.col("x.digits").alias("digits"), (F.col("was") - (F.col("x.upto") - F.col("x.n"))).alias("now"), F.col("x.n").alias("n")))
        state = run_table(state.join(found, state["_lbl"].eqNullSafe(found["_of"]), "left").select(
            "_lbl", F.when(F.col("done") | F.col("now").isNull(), F.col("left")).otherwise(F.col("now")).alias("left"),
            F.concat("prefix", F.when(F.col("done"), "").otherwise(F.coalesce("digits", F.lit("")))).alias("prefix"),
            (F.col("done") | F.col("now").isNull() | (F.col("now") >= F.col("n"))).alias("done")))
    return state.select("_lbl", F.when((F.col("left") > 0) & (F.col("prefix") != ""), F.concat("prefix", F.lit("~"))).alias("limit"))


def within_quota(df: DataFrame, label: str, key: Column, quotas: DataFrame) -> tuple[DataFrame, Column]:
    """``df`` with its class's limit, and the condition that a row is in the quota. ``key``: the row's
    hexadecimal key; ``quotas``: _lbl, quota."""
    found = limits(df.select(col_of(label).alias("_lbl"), key.alias("_h")), quotas).select(F.col("_lbl").alias("_limit_of"), F.col("limit").alias("_limit"))
    joined = df.join(found, col_of(label).eqNullSafe(F.col("_limit_of")), "left").drop("_limit_of")
    return joined, F.coalesce(key <= F.col("_limit"), F.lit(False))


def digits_for(rows: int, most: int = 2_000) -> int:
    """Hexadecimal digits that cut so many rows into buckets of about ``most``."""
    digits = 1
    while rows > most * 16 ** digits and digits < 8:
        digits += 1
    return digits


def bucket(key: Column, digits: int) -> Column:
    """Bucket number of a key by its first digits."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("long")


def offsets(rows: DataFrame, by: Sequence[str], bucket_col: str = "_b") -> DataFrame:
    """Rows per (by, bucket) and, as ``_off``, rows of smaller buckets of the same ``by``."""
    counts = rows.groupBy(*by, bucket_col).agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*by).orderBy(bucket_col).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_off", F.coalesce(F.sum("_c").over(before), F.lit(0)))
