"""Poisson bootstrap of a scored table by cells.

Rows with equal (label, prediction, score) are one cell of n rows; the weights of n rows drawn from
Poisson(1) add up to one draw from Poisson(n). So a replicate needs one draw per cell, not per row. A draw
inverts the distribution function at a uniform number of 32 bits: of md5(label|prediction|score|block|seed)
the replicates 4 * block to 4 * block + 3 take eight hexadecimal digits each. Draws depend on the cell
alone, so lost tasks repeat them, and SQL can draw the same.

Cells are dealt out by range of score. Every range sums its own counts per replicate; a running sum over
ranges (a few rows each) gives the counts above and below it, and a second pass over the ranges adds
the average precision. No task holds more than one range, drawn ``BLOCK`` replicates at a time.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.functions.scalar import col_of
from veritab.session import run_table

#: Cells of a range; replicates drawn at once; decimals of a score that tell cells apart.
RANGE, BLOCK, DIGITS = 20_000, 100, 9


def poisson_cdf(n: int) -> tuple[int, np.ndarray]:
    """(smallest k, P(K <= k) from there on) of Poisson(n), eight deviations and 20 to both sides."""
    low, high = max(0, int(n - 8 * math.sqrt(n) - 20)), int(n + 8 * math.sqrt(n) + 20)
    k = np.arange(low + 1, high + 1, dtype=np.float64)
    logs = np.concatenate([[low * math.log(n) - n - math.lgamma(low + 1)], math.log(n) - np.log(k)])
    return low, np.cumsum(np.exp(np.cumsum(logs)))


def draws(label: np.ndarray, prediction: np.ndarray, score: np.ndarray, n: np.ndarray, first: int, last: int, seed: object) -> np.ndarray:
    """Cells x replicates [first, last), both divisible by 4 but for the end: draws from Poisson(n)."""
    blocks = range(first // 4, -(-last // 4))
    u = np.empty((len(n), len(blocks) * 4))
    for i, (a, b, c) in enumerate(zip(label.tolist(), prediction.tolist(), score.tolist(), strict=True)):
        head = f"{a}|{b}|{c}|"
        digests = b"".join(hashlib.md5(f"{head}{block}|{seed}".encode()).digest() for block in blocks)
        u[i] = np.frombuffer(digests, ">u4")
    u = u[:, :last - first] / 2.0 ** 32
    out = np.empty(u.shape, dtype=np.int64)
    for size in np.unique(n).tolist():
        own = n == size
        low, cdf = poisson_cdf(size)
        out[own] = low + np.minimum(np.searchsorted(cdf, u[own].ravel(), side="right"), len(cdf) - 1).reshape(-1, u.shape[1])
    return out


def cells(df: DataFrame, label: str, pred: str, score: str, digits: int = DIGITS) -> DataFrame:
    """label, prediction, score (rounded, times 10^digits, long) and n of every cell; rows with a null
    among the three are in none."""
    scaled = F.round(col_of(score).cast("double") * F.lit(10.0 ** digits)).cast("long")
    return (df.select(col_of(label).cast("long").alias("label"), col_of(pred).cast("long").alias("prediction"), scaled.alias("score"))
            .dropna().groupBy("label", "prediction", "score").agg(F.count(F.lit(1)).alias("n")))


def _ranges(table: DataFrame) -> DataFrame:
    """The cells with the number of their range, written; equal scores share a range."""
    held = run_table(table)
    many = max(1, -(-held.count() // RANGE))
    held = held.repartitionByRange(max(many, 1), "score") if many > 1 else held.coalesce(1)
    return run_table(held.withColumn("part", F.spark_partition_id()))


def _arrays(part: pa.Table) -> tuple[np.ndarray, ...]:
    """(label, prediction, score, n) in falling order of score."""
    columns = [part.column(c).to_numpy() for c in ("label", "prediction", "score", "n")]
    order = np.lexsort((columns[1], columns[0], -columns[2]))
    return tuple(c[order] for c in columns)


def _blocks(replicates: int) -> list[tuple[int, int]]:
    return [(a, min(a + BLOCK, replicates)) for a in range(0, replicates, BLOCK)]


def weights(table: DataFrame, replicates: int, seed: object = 42) -> DataFrame:
    """Every cell once per replicate with its weight, a draw from Poisson(n)."""

    def run(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            label, prediction, score, n = (batch.column(c).to_numpy() for c in ("label", "prediction", "score", "n"))
            for a, z in _blocks(replicates):
                w = draws(label, prediction, score, n, a, z, seed)
                wide = z - a
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(c, wide)) for c in (label, prediction, score, n)]
                    + [pa.array(np.tile(np.arange(a, z, dtype=np.int32), len(n))), pa.array(w.ravel())],
                    ["label", "prediction", "score", "n", "replicate", "weight"])

    return table.select("label", "prediction", "score", "n").mapInArrow(
        run, "label long, prediction long, score long, n long, replicate int, weight long")


def _by_score(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums over the cells of each score."""
    return np.add.reduceat(x, first, axis=0)


def _split(label: np.ndarray, score: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positive, negative) weights per score, scores falling."""
    first = np.flatnonzero(np.r_[True, score[1:] != score[:-1]])
    yes = (label == 1)[:, None]
    return _by_score(w * yes, first).astype(np.float64), _by_score(w * ~yes, first).astype(np.float64)


def _per_range(ranges: DataFrame, replicates: int, seed: object, names: list[str], work: Callable) -> DataFrame:
    """One row per range and replicate: ``work(range number, arrays, draws, first, last)`` gives the columns."""
    schema = "part int, replicate int, " + ", ".join(f"{c} double" for c in names)

    def run(key: tuple, part: pa.Table) -> pa.Table:
        arrays, number, out = _arrays(part), key[0].as_py(), []
        for a, z in _blocks(replicates):
            columns = work(number, arrays, draws(*arrays, a, z, seed), a, z)
            out.append(np.stack(columns))
        wide = np.concatenate(out, axis=1)
        return pa.table({"part": pa.array(np.full(replicates, number), pa.int32()), "replicate": pa.array(np.arange(replicates), pa.int32()),
                         **{c: pa.array(v) for c, v in zip(names, wide, strict=True)}})

    return ranges.groupBy("part").applyInArrow(run, schema)


def replicate_metrics(df: DataFrame, label: str, pred: str, score: str, replicates: int = 1000, seed: object = 42) -> DataFrame:
    """Replicate, accuracy, precision, recall, f1, roc_auc, average_precision."""
    ranges = _ranges(cells(df, label, pred, score))

    def counts(number, arrays, w, a, z):  # noqa: ANN001, ANN202
        y, p, s, _ = arrays
        pos, neg = _split(y, s, w)
        below = neg.sum(axis=0) - np.cumsum(neg, axis=0)
        cell = [w[(y == i) & (p == j)].sum(axis=0).astype(np.float64) for i, j in ((1, 1), (0, 1), (1, 0), (0, 0))]
        return [*cell, pos.sum(axis=0), neg.sum(axis=0), (pos * (below + neg / 2)).sum(axis=0)]

    sums = run_table(_per_range(ranges, replicates, seed, ["tp", "fp", "fn", "tn", "pos", "neg", "u"], counts))
    # scores fall with the number of the range: counts above are those of later ranges
    above = Window.partitionBy("replicate").orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy("replicate").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    placed = run_table(sums.select("*", F.coalesce(F.sum("pos").over(above), zero).alias("pos_above"),
                                   F.coalesce(F.sum("neg").over(above), zero).alias("neg_above"), F.coalesce(F.sum("neg").over(below), zero).alias("neg_below")))
    lists = (placed.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("replicate", "pos_above", "neg_above"))).alias("x"))
             .select("part", F.col("x.pos_above").alias("pos_above"), F.col("x.neg_above").alias("neg_above")))

    def precision(number, arrays, w, a, z, at):  # noqa: ANN001, ANN202
        y, _, s, _ = arrays
        pos, neg = _split(y, s, w)
        tp, fp = at[0][a:z] + np.cumsum(pos, axis=0), at[1][a:z] + np.cumsum(neg, axis=0)
        return [np.sum(np.divide(pos * tp, tp + fp, out=np.zeros_like(pos), where=pos > 0), axis=0)]

    def second(key: tuple, part: pa.Table, offsets: pa.Table) -> pa.Table:
        arrays, at = _arrays(part), [np.array(offsets.column(c)[0].as_py()) for c in ("pos_above", "neg_above")]
        values = np.concatenate([precision(None, arrays, draws(*arrays, a, z, seed), a, z, at)[0] for a, z in _blocks(replicates)])
        return pa.table({"replicate": pa.array(np.arange(replicates), pa.int32()), "s": pa.array(values)})

    ap = (ranges.groupBy("part").cogroup(lists.groupBy("part")).applyInArrow(second, "replicate int, s double")
          .groupBy("replicate").agg(F.sum("s").alias("s")))
    total = placed.groupBy("replicate").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn", "pos", "neg")],
                                            F.sum(F.col("u") + F.col("pos") * F.col("neg_below")).alias("u"))
    both = total.join(ap, "replicate")
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def share(a, b):  # noqa: ANN001, ANN202
        return F.when(b > 0, a / F.nullif(b, zero)).otherwise(0.0)

    return (both.withColumn("precision", share(tp, tp + fp)).withColumn("recall", share(tp, tp + fn))
            .select("replicate", share(tp + tn, tp + fp + fn + tn).alias("accuracy"), "precision", "recall",
                    share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")).alias("f1"),
                    F.when((F.col("pos") > 0) & (F.col("neg") > 0), F.try_divide(F.col("u"), F.col("pos") * F.col("neg"))).alias("roc_auc"),
                    F.when(F.col("pos") > 0, F.try_divide(F.col("s"), F.col("pos"))).alias("average_precision")))
