"""Operator 4: shards along a Hilbert curve over several metadata dimensions.

Every dimension is quantised into 2^bits ranges at its quantiles (strings by their whole sort order, from
the cumulative counts of their distinct values), the ranges form a cell, and cells are visited in the order of their Hilbert curve index. Runs of that order are cut into shards
whose row counts differ by one at most (law ``rows``), so a file holds a compact box of all
dimensions at once and its minimum and maximum statistics prune on any of them.

DataFrame functions only. A cell is numbered in slices of about ``SLICE`` rows by a hash of the
row, so a source or a group of copies with a third of all rows spreads over many tasks. The cell
table has at most 2^(bits * dimensions) rows, whatever the input, and only it is broadcast.
Nulls in a dimension lie in its lowest range; a null text has size ``OVERHEAD`` and checksum 0;
rows that are equal in everything are numbered in any order; an empty table gives no rows;
``shard_documents`` reads doc_id, text and its dimensions only, so other columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from veritab.operators.cumulative import running_sums

from .shared import Scratch, table

#: Bytes added to each text's size; rows in one numbering window; bits per dimension.
OVERHEAD, SLICE, BITS = 16, 50_000, 4


def _cuts(df: DataFrame, names: list[str], ranges: int) -> dict[str, list]:
    """At most ``ranges`` - 1 ascending values of each dimension that cut its rows into about equal ranges: approximate
    quantiles of numbers, exact ones of strings and other types over their whole sort order."""
    steps = [i / ranges for i in range(1, ranges)]
    numbers = [f.name for f in df.schema.fields if f.name in names and isinstance(f.dataType, NumericType)]
    found = {}
    if numbers:
        found = df.agg(*[F.percentile_approx(F.col(n).cast("double"), steps, 10_000).alias(n) for n in numbers]).first().asDict()
    for n in (n for n in names if n not in numbers):
        counted = running_sums(df.where(F.col(n).isNotNull()), n, {"n": F.lit(1)})
        found[n] = counted.agg(*[F.min(F.when(F.col("cum_n") >= F.col("tot_n") * p, F.col(n))) for p in steps]).first()
    return {n: sorted({c for c in found[n] or [] if c is not None}) for n in names}


def _cells(df: DataFrame, dims: list[str], bits: int) -> tuple[DataFrame, list[str]]:
    """Adds the range number of every dimension (0 to 2^bits - 1)."""
    cuts = _cuts(df, dims, 1 << bits)
    names = [f"cell_{i}" for i in range(len(dims))]
    made = {}
    for name, d in zip(names, dims, strict=True):
        made[name] = F.coalesce(reduce(lambda a, c, v=F.col(d): a + (v > c).cast("int"), cuts[d], F.lit(0)), F.lit(0))
    return df.withColumns(made), names


def hilbert_index(df: DataFrame, names: list[str], bits: int, out: str) -> DataFrame:
    """Adds the Hilbert curve index of integer coordinates (Skilling's transform)."""
    n = len(names)
    for q in (1 << k for k in range(bits - 1, 0, -1)):
        for name in names:
            first, swap = names[0], (F.col(names[0]).bitwiseXOR(F.col(name))).bitwiseAND(F.lit(q - 1))
            hit = F.col(name).bitwiseAND(F.lit(q)) != 0
            step = {first: F.when(hit, F.col(first).bitwiseXOR(F.lit(q - 1))).otherwise(F.col(first).bitwiseXOR(swap))}
            if name != first:
                step[name] = F.when(hit, F.col(name)).otherwise(F.col(name).bitwiseXOR(swap))
            df = df.withColumns(step)
    for a, b in zip(names, names[1:], strict=False):
        df = df.withColumn(b, F.col(b).bitwiseXOR(F.col(a)))
    flips = F.lit(0)
    for q in (1 << k for k in range(bits - 1, 0, -1)):
        flips = flips.bitwiseXOR(F.when(F.col(names[-1]).bitwiseAND(F.lit(q)) != 0, q - 1).otherwise(0))
    df = df.withColumn("hilbert_flips", flips)
    df = df.withColumns({c: F.col(c).bitwiseXOR(F.col("hilbert_flips")) for c in names})
    index = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for i, c in enumerate(names):
            index = index + F.shiftleft(F.shiftright(F.col(c), bit).bitwiseAND(F.lit(1)).cast("long"), bit * n + n - 1 - i)
    return df.withColumn(out, index).drop("hilbert_flips")


def hilbert_shards(scratch: Scratch, rows: DataFrame, dims: list[str], ties: list[str], shards: int,
                   bits: int = BITS) -> DataFrame:
    """Adds curve, shard and slot to every row. ``ties``: columns that order a cell's rows."""
    placed, names = _cells(rows, dims, bits)
    placed = scratch.save(placed, "placed")
    cells = placed.groupBy(*names).agg(F.count("*").alias("cell_rows"))
    cells = hilbert_index(cells.withColumns({f"at_{c}": F.col(c) for c in names}), [f"at_{c}" for c in names], bits, "curve")
    cells = F.broadcast(cells.select(*names, "curve", F.ceil(F.col("cell_rows") / SLICE).alias("slices")))
    sliced = scratch.save(
        placed.join(cells, names).drop(*names)
        .withColumn("slice", F.pmod(F.xxhash64(*ties), F.col("slices"))).drop("slices"), "sliced")
    sizes = sliced.groupBy("curve", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("curve").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    curve = sizes.groupBy("curve").agg(F.sum("n").alias("n"))  # at most one row per cell
    ahead = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    curve = curve.select("curve", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"),
                         F.sum("n").over(Window.partitionBy()).alias("total"))
    starts = (sizes.withColumn("within", F.coalesce(F.sum("n").over(before), F.lit(0))).join(F.broadcast(curve), "curve")
              .select("curve", "slice", (F.col("ahead") + F.col("within")).alias("start"), "total"))
    rank = F.row_number().over(Window.partitionBy("curve", "slice").orderBy(*ties))
    numbered = (sliced.withColumn("rank", rank).join(starts, ["curve", "slice"])
                .withColumn("rank", F.col("rank") - 1 + F.col("start")))
    shard = F.expr(f"rank * {shards} div total")
    first = F.expr(f"(shard * total + {shards} - 1) div {shards}")
    return (numbered.withColumn("shard", shard).withColumn("slot", F.col("rank") - first)
            .drop("rank", "start", "total", "slice"))


def shard_documents(docs: DataFrame, shards: int, dims: tuple[str, ...] = ("lang", "source", "size")) -> DataFrame:
    """doc_id, size, text_crc32, curve, shard, slot of every document."""
    scratch = Scratch(docs.sparkSession, "sharding")
    body = F.encode("text", "UTF-8")
    rows = docs.select("doc_id", *[d for d in dims if d != "size"],
                       (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
                       F.coalesce(F.crc32(body), F.lit(0)).alias("text_crc32"))
    out = hilbert_shards(scratch, scratch.save(rows, "rows"), list(dims), ["text_crc32", "doc_id", "size"], shards)
    return out.select("doc_id", "size", "text_crc32", "curve", F.col("shard").cast("int").alias("shard"),
                      F.col("slot").cast("long").alias("slot"))


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Writes the documents as one folder per shard, in curve order. ``doc_id`` is the key."""
    (docs.join(placed.select("doc_id", "shard", "slot"), "doc_id").repartition("shard")
     .sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path))


def op4_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")
