"""Permutation importance of a linear model without moving arrays.

Rows get one dense rank by the hash of their key. For every (feature, repeat) a keyed bijection of the ranks (a
Feistel network, walked until it stays below the number of rows) names the row that receives the feature's value; only
the receiver's place, the job and the weighted value are shuffled, about 32 bytes each. A receiver scores
``z + w_j * (received - own)``. Rows of a block of ranks meet their values in one task of bounded size, which emits the
confusion cells of all jobs; these are added up, one row per job comes to the driver.

Rows with a null label, null array or null or NaN element take no part. Fewer than two rows leave nothing to swap:
every importance is 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.functions.scalar import col_of
from veritab.operators.batched import metrics_of
from veritab.operators.features import _class_rank
from veritab.session import run_table

#: Rounds of the network; values that one block of ranks receives; values made at once; values scored at once.
ROUNDS, BLOCK_VALUES, CHUNK, SCORED = 4, 500_000, 500_000, 100_000


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def permuted(ranks: np.ndarray, n: int, key: int) -> np.ndarray:
    """Images of ranks below ``n`` under the bijection of [0, n) that ``key`` names."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))
    out = ranks.astype(np.uint64)
    left = np.arange(len(out))
    while len(left):
        v = out[left]
        a, b = v >> half, v & mask
        for k in keys:
            a, b = b, a ^ (_mix(b + k) & mask)
        out[left] = (a << half) | b
        left = left[out[left] >= n]
    return out.astype(np.int64)


def job_key(feature: int, repeat: int, seed: int) -> int:
    return (seed * 1_000_003 + feature) * 1_000_003 + repeat & (2 ** 64 - 1)


def importance(df: DataFrame, array_col: str, key: str, weights: Sequence[float], bias: float, indices: Sequence[int], repeats: int = 10,
               seed: int = 42, label: str = "label", metric: str = "recall") -> DataFrame:
    """feature_index, importance_mean, importance_std (n): ``metric`` of the linear model (class 1 where the score is at
    least 0) less that with the feature's values permuted, over ``repeats`` permutations."""
    x = F.col(array_col).cast("array<double>")
    rows = df.select(col_of(key).alias("k"), x.alias("x"), col_of(label).cast("int").alias("y")).where(
        "y IS NOT NULL AND x IS NOT NULL AND forall(x, v -> v IS NOT NULL AND NOT isnan(v))").withColumn("_one", F.lit(1))
    table = run_table(_class_rank(rows, "_one", ["k"], seed=f"p{seed}").select((F.col("_rank") - 1).cast("long").alias("rank"), "y", "x"))
    n = table.count()
    jobs = [(j, r) for j in indices for r in range(repeats)]
    w, picked = np.asarray(weights, dtype=np.float64), np.array([j for j, _ in jobs], dtype=np.int64)
    per = max(1, BLOCK_VALUES // max(len(jobs), 1))  # ranks of a block

    def matrix(column: pa.ChunkedArray | pa.Array, rows_: int) -> np.ndarray:
        flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        return flat.flatten().to_numpy(zero_copy_only=False).reshape(rows_, -1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CHUNK // max(len(jobs), 1))
        for whole in batches:
            for start in range(0, len(whole), step):
                batch = whole.slice(start, step)
                ranks, values = batch.column("rank").to_numpy(), matrix(batch.column("x"), len(batch)) * w
                to = np.stack([permuted(ranks, n, job_key(j, r, seed)) for j, r in jobs], axis=1)
                at = to % per * len(jobs) + np.arange(len(jobs))
                yield pa.RecordBatch.from_arrays([pa.array((to // per).ravel()), pa.array(at.ravel()), pa.array(values[:, picked].ravel())],
                                                 ["block", "at", "value"])

    def cells(own: pa.Table, received: pa.Table) -> pa.Table:
        count = np.zeros((len(jobs) + 1, 4), dtype=np.int64)
        if own.num_rows:
            place = own.column("rank").to_numpy() % per
            order = np.argsort(place)
            values = (matrix(own.column("x"), own.num_rows) * w)[order]
            y, z = (own.column("y").to_numpy()[order] > 0).astype(np.int64), values.sum(1) + bias
            for batch in received.select(["at", "value"]).to_batches(SCORED):
                where, job = np.divmod(batch.column("at").to_numpy(), len(jobs))
                score = z[where] + batch.column("value").to_numpy() - values[where, picked[job]]
                count[:-1] += np.bincount(job * 4 + y[where] * 2 + (score >= 0), minlength=4 * len(jobs)).reshape(-1, 4)
            count[-1] = np.bincount(y * 2 + (z >= 0), minlength=4)
        return pa.table({"job": pa.array(np.arange(len(jobs) + 1), pa.int32()), "tn": count[:, 0], "fp": count[:, 1], "fn": count[:, 2], "tp": count[:, 3]})

    columns = "feature_index int, importance_mean double, importance_std double"
    if not jobs:
        return df.sparkSession.createDataFrame([], columns)
    if n < 2:
        return df.sparkSession.createDataFrame([(int(j), 0.0, 0.0) for j in indices], columns)
    sent = table.select("rank", "x").mapInArrow(send, "block long, at long, value double")
    met = table.withColumn("block", F.expr(f"rank div {per}")).groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(
        cells, "job int, tn long, fp long, fn long, tp long")
    found = {r["job"]: metrics_of(np.array([r["tp"], r["fp"], r["fn"], r["tn"]]))[metric]
             for r in met.groupBy("job").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]).collect()}
    drops = found[len(jobs)] - np.array([found[i] for i in range(len(jobs))]).reshape(len(indices), repeats)
    out = [(int(j), float(d.mean()), float(d.std())) for j, d in zip(indices, drops, strict=True)]
    return df.sparkSession.createDataFrame(out, columns).orderBy(F.desc("importance_mean"), "feature_index")
